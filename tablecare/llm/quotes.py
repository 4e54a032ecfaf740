"""Chat formatting by quotation linking [native].

1. Every message is cut into lines; leading ``>`` marks give a line's quote
   level. Lines of level 0 are the message's own text. Each quoted line, each
   maximal run of lines of one level, each paragraph of it (cut at blank lines)
   and each sentence of a paragraph is a quoted passage, so a quotation may be
   re-wrapped or hold one sentence of a line. Less than a sentence of what was
   said (and less than a line) is not linked.
2. Passages are normalised (lower case, single spaces, trimmed) and hashed, as
   are the own lines, sentences, paragraphs, runs and whole own text of every
   message.
3. A passage links to the latest earlier message of its conversation that holds
   it: an as-of step over (conversation, hash), in blocks of ``BLOCK`` turns with
   the last turn of earlier blocks carried over, so a phrase that everybody
   quotes is not sorted in one task. Only hashes that are quoted at all enter.
4. Per message and level the message with the most quoted characters wins (ties:
   the latest); the lowest level that has one gives ``reply_to``.
5. Threads: every message takes the first message of its chain of replies by
   pointer doubling (rounds grow with the logarithm of the longest chain).
6. Reply order inside a conversation: threads by the turn of their first
   message, then turns, so a message follows everything it quotes. ``position``
   comes from a range-partitioned sort: places within a partition plus the sizes
   of the partitions before, so a conversation may span many tasks.

Each row also holds its message as a chat segment; segments joined in order of
``position`` are the conversation without quotes.

Defined cases: rows with NULL conv_id form one conversation, apart from that of an
empty conv_id; a NULL turn counts as -1 (and shares a place with a turn of -1); NULL text counts as '' and NULL role as ''; rows with
equal conv_id and turn are one place in the order: their passages are pooled,
and each row is returned with the same links and position; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecare.llm.common import min_partitions, quoted, stage

QUOTE_MARKS = r"^((?:\x20{0,3}>)+)\x20?"
# After the end of a sentence with its closing marks; scripts without spaces need none.
SENTENCE_END = r"""(?<=[.!?…][\])"'”’»]{0,2})\x20|(?<=[。！？][」』”’）]{0,2})(?![」』”’）。！？])\x20?"""
BLOCK = 1024
KEYS = ["conv", "at"]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, at, conv_id, turn, role and runs: array<struct<level, lines>> of each message."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    lines = F.transform(F.split(text, "\r?\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, QUOTE_MARKS, 1), r"[^>]", "")).alias("level"),
        F.regexp_replace(line, QUOTE_MARKS, "").alias("body")))
    rows = messages.select(
        # '' stands for NULL alone: every other key begins with a sign
        F.coalesce(F.concat(F.lit("="), quoted(conv_col).cast("string")), F.lit("")).alias("conv"),
        F.coalesce(quoted(turn_col).cast("long"), F.lit(-1)).alias("at"),
        quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"),
        F.coalesce(quoted(role_col), F.lit("")).alias("role"), lines.alias("lines"))
    first = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: (i == 1) | (
        F.element_at("lines", i)["level"] != F.element_at(
            "lines", F.greatest(i - 1, F.lit(1)))["level"]))
    rows = rows.withColumn("first", first)
    runs = F.transform("first", lambda s, j: F.struct(
        F.element_at("lines", s)["level"].alias("level"),
        F.transform(F.slice("lines", s, F.coalesce(F.get("first", j + 1), F.size("lines") + 1) - s),
                    lambda x: x["body"]).alias("lines")))
    return rows.withColumn("runs", runs).drop("lines", "first")


def own_text(runs: str = "runs") -> Column:
    own = F.flatten(F.transform(F.filter(runs, lambda r: r["level"] == 0), lambda r: r["lines"]))
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def _pieces(level_filter) -> Column:
    """Normalised lines, sentences, paragraphs and runs of the levels wanted, with their level.

    Blank ones are left out.
    """
    wanted = F.filter("runs", lambda r: level_filter(r["level"]))

    def of_run(r: Column) -> Column:
        lines = F.transform(r["lines"], normalised)
        # a blank line becomes the one line break that stays
        paragraphs = F.transform(F.split(F.array_join(F.transform(
            lines, lambda x: F.when(x == "", F.lit("\n")).otherwise(x)), " "), "\n"), F.trim)
        sentences = F.flatten(F.transform(paragraphs, lambda x: F.split(x, SENTENCE_END)))
        whole = F.array(F.array_join(F.filter(lines, lambda x: x != ""), " "))
        return F.transform(F.array_distinct(F.concat(lines, sentences, paragraphs, whole)),
                           lambda x: F.struct(r["level"].alias("level"), F.trim(x).alias("text")))

    return F.array_distinct(F.filter(F.flatten(F.transform(wanted, of_run)), lambda p: p["text"] != ""))


def links(messages: DataFrame) -> DataFrame:
    """(conv, at, level, source): the earlier message each quote level comes from."""
    passages = stage(messages.filter(F.exists("runs", lambda r: r["level"] > 0))
                     .select(*KEYS, F.explode(_pieces(lambda v: v > 0)).alias("p"))
                     .select(*KEYS, "p.level", F.xxhash64("p.text").alias("hash"),
                             F.length("p.text").alias("size"), F.md5("p.text").alias("check"))
                     .distinct(), "passages")
    wanted = passages.select("conv", "hash", "check").distinct()
    whole = F.array(F.struct(F.lit(0).alias("level"), normalised(own_text()).alias("text")))
    originals = (messages.select(*KEYS, F.explode(F.array_distinct(F.concat(
        _pieces(lambda v: v == 0), F.filter(whole, lambda p: p["text"] != "")))).alias("p"))
        .select(*KEYS, F.xxhash64("p.text").alias("hash"), F.md5("p.text").alias("check"))
        .join(wanted, ["conv", "hash", "check"], "left_semi").distinct())
    key = ["conv", "hash", "check"]
    events = (originals.select(*key, "at", F.lit(0).alias("quote")).unionByName(
        passages.select(*key, "at", F.lit(1).alias("quote")).distinct())
        .withColumn("block", F.expr(f"at div {BLOCK}")))
    last = events.filter("quote = 0").groupBy(*key, "block").agg(F.max("at").alias("last"))
    blocks = events.select(*key, "block").distinct().join(last, [*key, "block"], "left")
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*key, "block", F.max("last").over(before).alias("carried"))
    here = Window.partitionBy(*key, "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = (events.withColumn("near", F.max(F.when(F.col("quote") == 0, F.col("at"))).over(here))
             .filter("quote = 1").join(carried, [*key, "block"])
             .select(*key, "at", F.coalesce("near", "carried").alias("source"))
             .filter("source IS NOT NULL"))
    sums = (passages.join(found, [*key, "at"]).groupBy(*KEYS, "level", "source")
            .agg(F.sum("size").alias("size")))
    return sums.groupBy(*KEYS, "level").agg(
        F.max_by("source", F.struct("size", "source")).alias("source"))


def threads(replies: DataFrame) -> DataFrame:
    """(conv, at, root, depth) of every message that replies; ``replies``: (conv, at, reply_to)."""
    now = stage(replies.select(*KEYS, F.col("reply_to").alias("root"), F.lit(1).alias("depth")),
                "threads")
    while True:
        up = now.select("conv", F.col("at").alias("root"), F.col("root").alias("higher"),
                        F.col("depth").alias("more"))
        new = stage(now.join(up, ["conv", "root"], "left").select(
            *KEYS, F.coalesce("higher", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("higher").isNotNull().alias("moved")), "threads")
        moved = new.filter("moved").limit(1).count()
        now = new.drop("moved")
        if not moved:
            return now


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message, see the module's text.

    conv_id, turn, role, body (own text), reply_to, quoted (array of (level, source)),
    thread, depth, position, segment.
    """
    rows = parsed(messages, conv_col, turn_col, role_col, text_col)
    linked = stage(links(rows).groupBy(*KEYS).agg(
        F.min_by("source", "level").alias("reply_to"),
        F.array_sort(F.collect_list(F.struct("level", "source"))).alias("quoted")), "links")
    tree = threads(linked)
    places = (rows.select(*KEYS).distinct().join(tree, KEYS, "left").join(linked, KEYS, "left")
              .select(*KEYS, F.coalesce("root", "at").alias("thread"),
                      F.coalesce("depth", F.lit(0)).alias("depth"), "reply_to", "quoted"))
    order = ["conv", "thread", "at"]
    ranked = stage(places.repartitionByRange(min_partitions(rows), *order)
                   .sortWithinPartitions(*order)
                   .withColumn("mark", F.monotonically_increasing_id()), "places")
    part = F.shiftright("mark", 33)
    sizes = ranked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))   # one per task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = (ranked.withColumn("part", part).join(offsets, "part")
              .withColumn("rank", F.col("offset") + F.col("mark").bitwiseAND((1 << 33) - 1)))
    starts = ranked.groupBy("conv").agg(F.min("rank").alias("start"))
    placed = ranked.join(starts, "conv").select(
        *KEYS, "thread", "depth", "reply_to", "quoted", (F.col("rank") - F.col("start")).alias("position"))
    body = own_text()
    return (rows.select(*KEYS, "conv_id", "turn", "role", body.alias("body")).join(placed, KEYS)
            .select("conv_id", "turn", "role", "body", "reply_to", "quoted", "thread", "depth",
                    "position", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "body",
                                         F.lit("\n<|end|>\n")).alias("segment")))
