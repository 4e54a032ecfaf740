"""Text rules over names: ordered category rules and short names.

Both compile to one chained ``CASE WHEN`` expression, so a table of millions of
rows is categorised inside codegen without any Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RULE_KINDS = ("exact", "set", "contains", "prefix", "suffix")


@dataclass(frozen=True)
class Rule:
    """One categorising rule.

    ``kind`` is one of ``exact`` (value equals ``pattern``), ``set`` (value is
    one of ``pattern``), ``contains`` (``pattern`` occurs in the value),
    ``prefix`` / ``suffix`` (value starts / ends with ``pattern``).
    """

    kind: str
    pattern: str | Sequence[str]
    label: str

    def __post_init__(self):
        if self.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r}; choose from {RULE_KINDS}")

    def matches(self, c: Column) -> Column:
        if self.kind == "exact":
            return c == F.lit(self.pattern)
        if self.kind == "set":
            return c.isin(list(self.pattern))
        if self.kind == "contains":
            return F.contains(c, F.lit(self.pattern))
        if self.kind == "prefix":
            return F.startswith(c, F.lit(self.pattern))
        return F.endswith(c, F.lit(self.pattern))


def categorize(c: Column | str, rules: Iterable[Rule], default: str = "other",
               null_label: str | None = None) -> Column:
    """Label each value by the first rule that matches, else ``default``.

    A NULL value gets ``null_label`` (``default`` when not given).
    """
    c = F.col(c) if isinstance(c, str) else c
    rules = list(rules)
    if not rules:
        expr = F.lit(default)
    else:
        expr = None
        for rule in rules:
            cond = F.coalesce(rule.matches(c), F.lit(False))
            expr = F.when(cond, F.lit(rule.label)) if expr is None else expr.when(cond, F.lit(rule.label))
        expr = expr.otherwise(F.lit(default))
    return F.when(c.isNull(), F.lit(null_label if null_label is not None else default)).otherwise(expr)


# Fixed values that must equal the reference: its return-annotation categories,
# in order (first hit wins); NULL is "not_annotated", anything else "object".
ANNOTATION_RULES = (
    Rule("exact", "None", "void"),
    Rule("set", ("typing.Self", "Self"), "self"),
    Rule("set", ("<class 'str'>", "<class 'int'>", "<class 'float'>", "<class 'bool'>",
                 "<class 'bytes'>"), "primitive"),
    Rule("contains", "typing.Dict", "dictionary"),
    Rule("prefix", "Dict[", "dictionary"),
    Rule("contains", "typing.List", "list"),
    Rule("prefix", "List[", "list"),
    Rule("contains", "typing.Tuple", "tuple"),
    Rule("prefix", "Tuple[", "tuple"),
    Rule("contains", "typing.Iterator", "iterator"),
    Rule("prefix", "Iterator[", "iterator"),
    Rule("contains", "ItemPaged", "paged_collection"),
    Rule("contains", "typing.Union", "union"),
    Rule("prefix", "Union[", "union"),
)
ANNOTATION_DEFAULT = "object"
ANNOTATION_NULL = "not_annotated"


def categorize_annotation(c: Column | str) -> Column:
    """The return-annotation categories as one ordered rule list."""
    return categorize(c, ANNOTATION_RULES, ANNOTATION_DEFAULT, ANNOTATION_NULL)


# Fixed values that must equal the reference: the wrapper printed around a
# class name, and the module prefix of typing names.
CLASS_OPEN = "<class '"
CLASS_CLOSE = "'>"
TYPING_PREFIX = "typing."


def short_name(c: Column | str) -> Column:
    """Readable short form of a dotted or wrapped type name.

    ``<class 'a.b.C'>`` -> ``C``; ``typing.X`` -> ``X`` (every ``typing.``
    removed); any other text with a dot -> the part after the last dot;
    otherwise the text itself. NULL stays NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    wrapped = F.startswith(c, F.lit(CLASS_OPEN)) & F.endswith(c, F.lit(CLASS_CLOSE))
    inner = F.regexp_extract(c, r"^<class '(.*)'>$", 1)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(wrapped, F.substring_index(inner, ".", -1))
        .when(F.startswith(c, F.lit(TYPING_PREFIX)), F.replace(c, F.lit(TYPING_PREFIX), F.lit("")))
        .otherwise(F.substring_index(c, ".", -1))
    )
