"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the operator semantics, not from the Spark code: each cleaning
step is one CTE over the previous one, starting from the ``dirty_orders`` text
in FIXTURES.md. DuckDB differences handled here: ``regexp_replace`` needs the
``'g'`` flag; ``%y`` maps 00-68 to 2000s, Spark's ``yy`` always to 2000-2099;
``try_cast('3.0' AS int)`` succeeds in DuckDB, so integers are guarded by a
digits pattern; DuckDB has no ``initcap``.
"""

from __future__ import annotations

from tablecare.plans.catalog import HOST_PATTERN, INDEX_NEEDLES, PART_RULES, RUN_A, RUN_B, URL_RULES

DIRTY = r"""
SELECT
  CASE WHEN o_orderkey%2=0 THEN 'o' ELSE 'O' END || o_orderkey::varchar AS "Order ID",
  CASE WHEN o_orderkey%20=3 THEN '   ' WHEN o_orderkey%20=13 THEN NULL
       ELSE '  cUSTOMER ' || o_custkey::varchar || ' ' END AS "Customer Name",
  CASE o_orderkey%3 WHEN 0 THEN upper(o_orderpriority)
       WHEN 1 THEN lower(o_orderpriority) ELSE o_orderpriority END AS "Order Type",
  CASE WHEN o_orderkey%25=7 THEN 'two' WHEN o_orderkey%25=17 THEN 'High'
       ELSE (o_orderkey%12)::varchar END AS "Risk Level",
  CASE o_orderkey%7 WHEN 0 THEN strftime(o_orderdate,'%-m/%-d/%y')
       WHEN 1 THEN strftime(o_orderdate,'%Y-%m-%d')
       WHEN 2 THEN strftime(o_orderdate,'%Y/%m/%d')
       WHEN 3 THEN strftime(o_orderdate,'%b %-d %Y')
       WHEN 4 THEN strftime(o_orderdate,'%m-%d-%Y')
       WHEN 5 THEN 'not a date' ELSE '32/13/2026' END AS "Created Date",
  CASE WHEN o_orderkey%30=20 THEN NULL ELSE CASE o_orderkey%4
       WHEN 0 THEN '$' || (o_orderkey%9+1)::varchar || ','
                   || lpad((o_orderkey%1000)::varchar,3,'0') || '.00'
       WHEN 1 THEN 'USD ' || (o_orderkey%5000)::varchar
       WHEN 2 THEN '-' || (o_orderkey%700)::varchar
       ELSE (o_orderkey%5000)::varchar END END AS "Base Price",
  CASE o_orderkey%2 WHEN 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS "Status"
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey%10=0)
"""

RAW = ["Order ID", "Customer Name", "Order Type", "Risk Level", "Created Date", "Base Price", "Status"]
C7 = ["order_id", "customer_name", "order_type", "risk_level", "created_date", "base_price", "status"]
C11 = C7 + ["preserve_date", "preserve_level", "preserve_price", "original_price_negative"]
C12 = C11 + ["duplicate_row"]
REQ = ["customer_name", "created_date", "risk_level"]
TYPES12 = {"order_id": "string", "customer_name": "string", "order_type": "string",
           "risk_level": "int", "created_date": "date", "base_price": "double", "status": "string",
           "preserve_date": "string", "preserve_level": "string", "preserve_price": "string",
           "original_price_negative": "boolean", "duplicate_row": "boolean"}
LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
            "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
            "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
            "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _all(fmt: str, cols) -> str:
    return ", ".join(fmt.format(c=q(c)) for c in cols)


# (name, select-list over the previous stage), in the declared order
STAGES = [
    ("dirty", None),
    ("s_headers", ", ".join(f"{q(r)} AS {c}" for r, c in zip(RAW, C7))),
    ("s_trim", "* REPLACE (" + _all("trim({c}) AS {c}", C7) + ")"),
    ("s_blank", "* REPLACE (" + _all("CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}", C7) + ")"),
    ("s_upper", "* REPLACE (upper(order_id) AS order_id)"),
    ("s_initcap", "* REPLACE (array_to_string(list_transform(string_split(customer_name, ' '), "
                  "lambda w: upper(w[1]) || lower(w[2:])), ' ') AS customer_name)"),
    ("s_lower", "* REPLACE (lower(order_type) AS order_type, lower(status) AS status)"),
    ("s_preserve", "*, created_date AS preserve_date, risk_level AS preserve_level, "
                   "base_price AS preserve_price"),
    ("s_currency", "* REPLACE (regexp_replace(regexp_replace(base_price, '[$,]', '', 'g'), "
                   "'USD\\s', '', 'g') AS base_price)"),
    ("s_cast", "* REPLACE (try_cast(base_price AS DOUBLE) AS base_price)"),
    ("s_flagneg", "*, coalesce(base_price < 0, false) AS original_price_negative"),
    ("s_fixneg", "* REPLACE (CASE WHEN base_price < 0 THEN base_price * -1 ELSE base_price END "
                 "AS base_price)"),
    ("s_dates", "* REPLACE (coalesce("
                "CASE WHEN try_strptime(created_date, '%m/%d/%y')::DATE < DATE '2000-01-01' "
                "THEN (try_strptime(created_date, '%m/%d/%y')::DATE + INTERVAL 100 YEAR)::DATE "
                "ELSE try_strptime(created_date, '%m/%d/%y')::DATE END, "
                "try_strptime(created_date, '%Y-%m-%d')::DATE, "
                "try_strptime(created_date, '%Y/%m/%d')::DATE, "
                "try_strptime(created_date, '%b %d %Y')::DATE, "
                "try_strptime(created_date, '%m-%d-%Y')::DATE) AS created_date)"),
    ("s_int", "* REPLACE (CASE WHEN regexp_matches(risk_level, '^\\s*-?[0-9]+\\s*$') "
              "THEN try_cast(trim(risk_level) AS INTEGER) END AS risk_level)"),
    ("s_range", "* REPLACE (CASE WHEN risk_level BETWEEN 1 AND 10 THEN risk_level END AS risk_level)"),
    ("s_flag", "*, (count(*) OVER (PARTITION BY " + ", ".join(C11) + ") > 1) AND "
               + " AND ".join(f"{c} IS NOT NULL" for c in C11) + " AS duplicate_row"),
]
STAGE_NAMES = [n for n, _ in STAGES]


def chain(upto: str, extra: str = "") -> str:
    """WITH clause of all stages up to ``upto`` (plus extra CTEs)."""
    parts = [f"dirty AS ({DIRTY})"]
    prev = "dirty"
    for name, sel in STAGES[1:]:
        parts.append(f"{name} AS (SELECT {sel} FROM {prev})")
        prev = name
        if name == upto:
            break
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def upto(stage: str) -> str:
    return chain(stage) + f"SELECT * FROM {stage}"


QCOND = "(" + " OR ".join(f"{c} IS NULL" for c in REQ) + " OR duplicate_row)"

NULLSAFE_FLAG = ("s_flag_ns AS (SELECT *, count(*) OVER (PARTITION BY " + ", ".join(C11)
                 + ") > 1 AS duplicate_row FROM s_range)")

REASONS = ("concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in REQ)
           + ", CASE WHEN duplicate_row THEN 'duplicate' END)")

OUTCOME = f"CASE WHEN {QCOND} THEN 'quarantine' ELSE 'clean' END AS outcome"


def _profile_rows(table: str, types: dict[str, str], name_of=lambda c: c) -> str:
    """One SELECT per column, UNION ALL'd: column, schema, nulls, blanks, distinct."""
    rows = []
    for c, t in types.items():
        blank = (f"count(*) FILTER (WHERE trim({q(c)}) = '')" if t == "string" else "NULL::BIGINT")
        rows.append(
            f"SELECT '{name_of(c)}' AS \"column\", '{t}' AS schema, "
            f"count(*) FILTER (WHERE {q(c)} IS NULL) AS null_count, {blank} AS blank_count, "
            f"(count(DISTINCT {q(c)}) + max(CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END))::BIGINT "
            f"AS distinct_count FROM {table}")
    return "\nUNION ALL\n".join(rows)


RAW_TYPES = {c: "string" for c in RAW}


def _runs_table(source: str, runs, extra_cols: str = "") -> str:
    return "\nUNION ALL\n".join(f"SELECT *, {extra_cols}'{r}' AS run_id FROM {source}" for r in runs)


def _rule_sql(col: str, rules, default: str) -> str:
    whens = []
    for r in rules:
        if r.kind == "exact":
            cond = f"{col} = '{r.pattern}'"
        elif r.kind == "set":
            cond = f"{col} IN (" + ", ".join(f"'{p}'" for p in r.pattern) + ")"
        elif r.kind == "contains":
            cond = f"contains({col}, '{r.pattern}')"
        elif r.kind == "prefix":
            cond = f"starts_with({col}, '{r.pattern}')"
        else:
            cond = f"ends_with({col}, '{r.pattern}')"
        whens.append(f"WHEN {cond} THEN '{r.label}'")
    return f"CASE WHEN {col} IS NULL THEN '{default}' " + " ".join(whens) + f" ELSE '{default}' END"


def build() -> dict[str, str]:
    flagged = chain("s_flag")
    tagged_sel = f"SELECT *, {OUTCOME} FROM s_flag"
    clean_cte = f"clean AS (SELECT * FROM s_flag WHERE NOT {QCOND})"
    sql: dict[str, str] = {}

    sql["scan_csv"] = f"WITH dirty AS ({DIRTY}) SELECT * FROM dirty"
    sql["scan_csv_infer"] = sql["scan_csv"]
    sql["scan_csv_permissive"] = (f"WITH dirty AS ({DIRTY}) "
                                  "SELECT *, NULL::VARCHAR AS _corrupt_record FROM dirty")
    sql["scan_csv_ragged"] = """
        SELECT o_orderkey::VARCHAR AS o_orderkey,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey::VARCHAR
                    WHEN o_orderkey % 11 = 0 THEN o_orderkey::VARCHAR || ',' || o_orderstatus || ',more'
               END AS _corrupt_record
        FROM orders"""
    # lines with four cells are ragged in place; those cut to three are whole
    sql["scan_csv_headers"] = """
        WITH r AS (SELECT *, o_orderkey % 4 = 3 AND o_orderkey % 7 <> 0 AS ragged,
                          1 + row_number() OVER (PARTITION BY o_orderkey % 4, o_orderkey // 4 % 8
                                                 ORDER BY o_orderkey) AS line FROM orders)
        SELECT o_orderkey::VARCHAR AS order_key, o_custkey::VARCHAR AS cust_key,
               CASE WHEN o_orderkey % 4 <> 2 THEN o_orderstatus END AS status,
               ragged, CASE WHEN ragged THEN line END AS line
        FROM r"""
    sql["sink_csv_texts"] = f"""
        SELECT doc_id, text || chr(10) || '"' || source || '", end\\' AS text,
               CASE WHEN doc_id % 3 = 0 THEN 'quarantine' ELSE 'clean' END AS outcome, '{RUN_A}' AS run_id
        FROM documents"""
    sql["rerun_replaces_run"] = f"""
        SELECT o_orderkey, 'clean' AS outcome, '{RUN_A}' AS run_id, 'runs' AS place
        FROM orders WHERE o_orderkey % 5 <> 0
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'quarantine' ELSE 'clean' END,
               '{RUN_B}', 'warehouse' FROM orders"""
    sql["sink_run_csv"] = (chain("s_flag", f"tagged AS ({tagged_sel})")
                           + _runs_table("tagged", [RUN_A, RUN_B]))
    sql["run_summary"] = (chain("s_flag", f"tagged AS ({tagged_sel})") + "\nUNION ALL\n".join(
        f"SELECT '{r}' AS run_id, count(*) FILTER (WHERE outcome = 'clean') AS clean_rows, "
        "count(*) FILTER (WHERE outcome = 'quarantine') AS quarantine_rows FROM tagged"
        for r in (RUN_A, RUN_B)))
    sql["sink_latest_and_runs"] = (
        chain("s_flag", f"tagged AS ({tagged_sel})")
        + "SELECT *, 'runs' AS copy FROM (" + _runs_table("tagged", [RUN_A, RUN_B]) + ")\n"
        + f"UNION ALL SELECT *, '{RUN_B}' AS run_id, 'latest' AS copy FROM tagged")
    sql["sink_warehouse"] = chain("s_flag", clean_cte) + _runs_table("clean", [RUN_A, RUN_B])
    sql["read_run"] = chain("s_flag", clean_cte) + f"SELECT *, '{RUN_B}' AS run_id FROM clean"
    sql["stamp_run_id"] = chain("s_flag", clean_cte) + f"SELECT *, '{RUN_A}' AS run_id FROM clean"
    validation = ("SELECT count(*) AS clean_rows, count(DISTINCT order_type) AS distinct_types, "
                  "count(DISTINCT status) AS distinct_statuses, "
                  "round(avg(base_price), 2) AS average_price FROM clean")
    sql["validate_load"] = chain("s_flag", clean_cte) + validation
    sql["validate_load_sql"] = chain("s_flag", clean_cte) + validation
    sql["run_end_to_end"] = (
        chain("s_flag", clean_cte + ",\nt AS (SELECT count(*) AS total_rows, "
              f"count(*) FILTER (WHERE NOT {QCOND}) AS clean_rows, "
              f"count(*) FILTER (WHERE {QCOND}) AS quarantine_rows FROM s_flag),\n"
              "v AS (SELECT count(DISTINCT order_type) AS distinct_types, "
              "count(DISTINCT status) AS distinct_statuses, "
              "round(avg(base_price), 2) AS average_price FROM clean)")
        + f"SELECT '{RUN_B}' AS run_id, total_rows, clean_rows, quarantine_rows, "
          "(SELECT distinct_types FROM v) AS distinct_types, "
          "(SELECT distinct_statuses FROM v) AS distinct_statuses, "
          "(SELECT average_price FROM v) AS average_price, true AS load_complete FROM t")
    sql["preview"] = ("SELECT *, (SELECT count(*) FROM (SELECT 1 FROM orders LIMIT 31)) > 30 "
                      "AS truncated FROM orders ORDER BY o_orderkey LIMIT 30")

    for key, stage in [("normalize_headers", "s_headers"), ("trim_strings", "s_trim"),
                       ("blank_to_null", "s_blank"), ("case_upper", "s_upper"),
                       ("case_title", "s_initcap"), ("case_lower", "s_lower"),
                       ("preserve_original", "s_preserve"), ("clean_currency", "s_currency"),
                       ("cast_price", "s_cast"), ("flag_negative", "s_flagneg"),
                       ("fix_negative", "s_fixneg"), ("parse_dates", "s_dates"),
                       ("try_cast_int", "s_int"), ("range_check", "s_range"),
                       ("flag_duplicates", "s_flag"), ("fill_default", "s_flag")]:
        sql[key] = upto(stage)
    sql["flag_duplicates_join"] = upto("s_flag")
    sql["flag_duplicates_fingerprint"] = upto("s_flag")
    sql["flag_duplicates_nullsafe"] = chain("s_range", NULLSAFE_FLAG) + "SELECT * FROM s_flag_ns"
    sql["null_check"] = (chain("s_range") + "SELECT *, ("
                         + " OR ".join(f"{c} IS NULL" for c in REQ) + ") AS missing_required FROM s_range")
    sql["duplicate_groups"] = (chain("s_range") + "SELECT " + ", ".join(C11)
                               + ", count(*) AS copies FROM s_range GROUP BY ALL HAVING count(*) > 1")
    sql["quarantine_rows"] = flagged + f"SELECT * FROM s_flag WHERE {QCOND}"
    sql["clean_rows"] = flagged + f"SELECT * FROM s_flag WHERE NOT {QCOND}"
    sql["clean_table"] = sql["clean_rows"]
    sql["quarantine_table"] = flagged + f"SELECT *, {REASONS} AS reasons FROM s_flag WHERE {QCOND}"
    by_name, unpriced, last = dict(STAGES), [], "u_bad"
    for stage in ("s_flagneg", "s_fixneg", "s_dates", "s_int", "s_range", "s_flag"):
        sel = by_name[stage]
        if stage == "s_flag":       # the new column is a key as well
            sel = sel.replace("base_price, status", "base_price, unparsable_base_price, status", 1)
        unpriced.append((f"u_{stage[2:]}", sel, last))
        last = f"u_{stage[2:]}"
    dear = "(preserve_price IS NOT NULL AND base_price IS NULL)"
    sql["quarantine_unparsable"] = (
        chain("s_preserve", "u_cast AS (SELECT * REPLACE (try_cast(base_price AS DOUBLE) AS base_price) "
              f"FROM s_preserve),\nu_bad AS (SELECT *, {dear} AS unparsable_base_price FROM u_cast),\n"
              + ",\n".join(f"{name} AS (SELECT {sel} FROM {prev})" for name, sel, prev in unpriced)
              ) + f"SELECT *, concat_ws(',', nullif({REASONS}, ''), CASE WHEN unparsable_base_price "
                  f"THEN 'unparsable_base_price' END) AS reasons FROM u_flag WHERE {QCOND} OR unparsable_base_price")
    three = "customer_name, status, risk_level"
    sql["flag_duplicates_first"] = chain("s_range") + (
        "SELECT *, customer_name IS NOT NULL AND status IS NOT NULL AND risk_level IS NOT NULL AND "
        f"row_number() OVER (PARTITION BY {three} ORDER BY created_date NULLS LAST, order_id NULLS LAST) > 1 "
        "AS duplicate_row FROM s_range")
    sql["split_summary"] = (flagged + "SELECT count(*) AS total_rows, "
                            f"count(*) FILTER (WHERE NOT {QCOND}) AS clean_rows, "
                            f"count(*) FILTER (WHERE {QCOND}) AS quarantine_rows FROM s_flag")
    sql["plan_steps"] = flagged + tagged_sel
    sql["stream_duplicates"] = flagged + tagged_sel

    sql["row_count"] = f"WITH dirty AS ({DIRTY}) SELECT count(*) AS rows FROM dirty"
    sql["distinct_counts"] = (f"WITH dirty AS ({DIRTY}) " + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", (count(DISTINCT {q(c)}) + max(CASE WHEN {q(c)} IS NULL "
        f"THEN 1 ELSE 0 END))::BIGINT AS distinct_count FROM dirty" for c in RAW))
    sql["duplicate_ids"] = (
        f"WITH dirty AS ({DIRTY}), x AS (SELECT count(*) AS rows, (count(DISTINCT \"Order ID\") + "
        "max(CASE WHEN \"Order ID\" IS NULL THEN 1 ELSE 0 END))::BIGINT AS distinct_ids FROM dirty) "
        "SELECT rows, distinct_ids, rows - distinct_ids AS duplicate_ids FROM x")
    sql["profile"] = flagged + _profile_rows("s_flag", TYPES12)
    sql["profile_raw"] = f"WITH dirty AS ({DIRTY}) " + _profile_rows("dirty", RAW_TYPES)
    sql["profile_lineitem"] = _profile_rows("lineitem", LINEITEM)
    sql["profile_merged"] = ('SELECT "column", schema, null_count, blank_count, true AS distinct_close '
                             f"FROM ({sql['profile_lineitem']})")
    sql["latest_survives"] = (
        "SELECT o_orderkey, o_orderstatus, 'during' AS copy FROM orders WHERE o_orderkey % 2 = 0 UNION ALL "
        "SELECT o_orderkey, o_orderstatus, 'after' AS copy FROM orders WHERE o_orderkey % 5 = 0")
    sql["read_run_manifest"] = (f"SELECT o_orderkey, o_custkey, o_orderstatus, '{RUN_B}' AS run_id FROM orders "
                                "WHERE o_orderkey BETWEEN 1000 AND 3000")
    sql["reconcile_load"] = """
        WITH loaded AS (
          SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
                 o_orderstatus FROM orders WHERE o_orderkey % 97 <> 5
          UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 97 = 6)
        SELECT o_orderkey, o_custkey, o_orderstatus, sum(e)::BIGINT AS expected_copies,
               sum(a)::BIGINT AS actual_copies
        FROM (SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS e, 0 AS a FROM orders
              UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 0, 1 FROM loaded)
        GROUP BY o_orderkey, o_custkey, o_orderstatus HAVING sum(e) <> sum(a)"""
    watch = ("Order Type", "Status", "Risk Level")
    sql["findings"] = (
        f"WITH dirty AS ({DIRTY}), p AS ({_profile_rows('dirty', RAW_TYPES)}), "
        "n AS (SELECT count(*) AS rows FROM dirty)\n"
        "SELECT CASE WHEN rows - distinct_count > 0 THEN 'WARNING' ELSE 'OK' END AS severity, "
        "\"column\", 'duplicate_ids' AS metric, rows - distinct_count AS value FROM p, n "
        "WHERE \"column\" = 'Order ID'\n"
        "UNION ALL SELECT 'WARNING', \"column\", 'null_count', null_count FROM p WHERE null_count > 0\n"
        "UNION ALL SELECT 'INFO', \"column\", 'distinct_count', distinct_count FROM p WHERE \"column\" IN ("
        + ", ".join(f"'{w}'" for w in watch) + ")")
    before = _profile_rows("dirty", RAW_TYPES, name_of=lambda c: c.lower().replace(" ", "_"))
    after = _profile_rows("clean", TYPES12)
    sql["profile_diff"] = (
        chain("s_flag", clean_cte + f",\nb AS ({before}),\na AS ({after})")
        + "SELECT coalesce(b.\"column\", a.\"column\") AS \"column\", "
        + ", ".join(f"b.{m} AS {m}_before" for m in ("schema", "null_count", "blank_count", "distinct_count"))
        + ", "
        + ", ".join(f"a.{m} AS {m}_after" for m in ("schema", "null_count", "blank_count", "distinct_count"))
        + " FROM b FULL OUTER JOIN a ON b.\"column\" = a.\"column\"")

    sql["keyword_search"] = ("SELECT * FROM documents WHERE contains(lower(text), 'licen') "
                             "OR contains(lower(lang), 'licen') OR contains(lower(source), 'licen')")
    sql["keyword_search_pages"] = ("SELECT page_id, url FROM pages WHERE contains(lower(url), 'example.org') "
                                   "OR contains(lower(html), 'example.org')")
    sql["keyword_search_index"] = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS needle, doc_id FROM documents WHERE contains(lower(text), lower('{n}')) "
        f"OR contains(lower(source), lower('{n}'))" for n in INDEX_NEEDLES)
    sql["usage_index"] = (
        "WITH u AS (SELECT event_type AS key, count(*) AS used FROM events "
        "WHERE event_type IS NOT NULL GROUP BY 1),\n"
        "t AS (SELECT key, string_agg(t, '|' ORDER BY t) AS types FROM (SELECT DISTINCT event_type AS key, "
        "props AS t FROM events WHERE event_type IS NOT NULL AND props IS NOT NULL) GROUP BY key),\n"
        "o AS (SELECT DISTINCT event_type AS key, user_id AS o FROM events "
        "WHERE event_type IS NOT NULL AND user_id IS NOT NULL),\n"
        "r AS (SELECT key, o, row_number() OVER (PARTITION BY key ORDER BY o) AS rn FROM o),\n"
        "e AS (SELECT key, string_agg(o::VARCHAR, ',' ORDER BY o) AS examples FROM r WHERE rn <= 10 "
        "GROUP BY key)\n"
        "SELECT u.key, u.used, coalesce(t.types, '') AS types, coalesce(e.examples, '') AS examples, "
        "(SELECT greatest(count(*) - 10, 0) FROM o WHERE o.key = u.key) AS more "
        "FROM u LEFT JOIN t ON u.key = t.key LEFT JOIN e ON u.key = e.key")
    sql["categorize"] = f"SELECT page_id, url, {_rule_sql('url', URL_RULES, 'plain')} AS category FROM pages"
    sql["categorize_parts"] = (f"SELECT p_partkey, p_type, {_rule_sql('p_type', PART_RULES, 'other')} "
                               "AS category FROM part")
    host = f"regexp_extract(url, '{HOST_PATTERN}', 1)"
    sql["short_name"] = (
        f"SELECT page_id, h AS host, CASE WHEN h IS NULL THEN NULL "
        "WHEN starts_with(h, '<class ''') AND ends_with(h, '''>') "
        "THEN string_split(h[9:-3], '.')[-1] "
        "WHEN starts_with(h, 'typing.') THEN replace(h, 'typing.', '') "
        f"ELSE string_split(h, '.')[-1] END AS short_name FROM (SELECT page_id, {host} AS h FROM pages)")
    sql["named_map"] = (
        "SELECT conv_id, count(DISTINCT role)::INTEGER AS names, "
        "arg_max(text, turn) FILTER (WHERE role = 'user') AS user_text, "
        "arg_max(text, turn) FILTER (WHERE role = 'assistant') AS assistant_text, "
        "arg_max(text, turn) FILTER (WHERE role = 'system') AS system_text "
        "FROM conversations WHERE role IS NOT NULL GROUP BY conv_id")
    sql["named_entries"] = ("SELECT conv_id, role, arg_max(text, turn) AS text FROM conversations "
                            "WHERE role IS NOT NULL GROUP BY conv_id, role")
    sql["usage_types"] = ("SELECT event_type AS key, props AS type, count(*) AS used FROM events "
                          "WHERE event_type IS NOT NULL AND props IS NOT NULL GROUP BY 1, 2")
    made = " UNION ALL ".join(
        f"SELECT page_id AS number, '{kind}' AS kind, {pattern} AS pattern, '{kind[0]}' || page_id AS label "
        f"FROM pages WHERE page_id % {n} = {r}" for n, r, kind, pattern in (
            (6, 1, "exact", "url"), (12, 2, "prefix", "substr(url, 1, 19)"), (12, 3, "suffix", "right(url, 2)"),
            (12, 4, "contains", "substr(url, 15, 7)"), (60, 5, "contains", "right(url, 2)")))
    sql["categorize_table"] = f"""
        WITH rules AS ({made}),
        hit AS (SELECT url, arg_min(label, number) AS label FROM (SELECT DISTINCT url FROM pages), rules
                WHERE (kind = 'exact' AND url = pattern) OR (kind = 'prefix' AND starts_with(url, pattern))
                   OR (kind = 'suffix' AND ends_with(url, pattern)) OR (kind = 'contains' AND contains(url, pattern))
                GROUP BY url)
        SELECT page_id, url, coalesce(label, 'plain') AS category FROM pages LEFT JOIN hit USING (url)"""
    return sql


ORACLE_SQL = build()
