"""Own rows shaped like the source pipeline's raw CSV: one per quarantine reason."""

import datetime as dt
import os

import pytest

from tablecare.plans.spec import MONSTER_SPEC, ORDERS_SPEC, Spec, Step, clean_table, tagged_table
from tablecare.session import fresh_dir
from tablecare.sources.files import read_csv, string_schema

HEADER = "Monster ID,Monster Name,Monster Type,Danger Level,Created Date,Base Price,Status"
LINES = [
    'm001,  grim reaper ,UNDEAD, 7 ,1/5/26,"$6,371.00",Active',      # clean, currency text
    "m002,Slime,ooze,2,2026-01-05,USD 1100,ACTIVE",                   # clean, code prefix
    "m003,Imp,Demon,3,Jan 5 2026,-500,retired",                      # clean, negative price
    "m004,,Beast,4,2026/01/05,10,active",                             # quarantine: no name
    "m005,Wolf,Beast,two,05-01-2026,20,active",                       # quarantine: bad level
    "m006,Bat,Beast,11,1/5/26,30,active",                             # quarantine: level range
    "m007,Orc,Brute,5,not a date,40,active",                          # quarantine: bad date
    "m008,Troll,Brute,6,1/5/26,50,active",                            # duplicate copy 1
    "m008,Troll,Brute,6,1/5/26,50,active",                            # duplicate copy 2
    "m009,Ghost,Undead,8,1/5/26,,inactive",                           # clean, no price
]


@pytest.fixture(scope="module")
def raw(spark):
    path = fresh_dir(spark, "golden")
    os.makedirs(path)
    with open(os.path.join(path, "monsters.csv"), "w", encoding="utf-8-sig") as f:
        f.write("\n".join([HEADER] + LINES) + "\n")
    return read_csv(spark, path, schema=string_schema(HEADER.split(",")))


def test_bom_dropped_and_header_kept(raw):
    assert raw.columns[0] == "Monster ID"
    assert raw.count() == 10


def test_split_counts_and_values(raw):
    out = clean_table(raw, MONSTER_SPEC, with_reasons=True)
    clean = {r.monster_id: r for r in out.clean.collect()}
    assert sorted(clean) == ["M001", "M002", "M003", "M009"]
    m1 = clean["M001"]
    assert (m1.monster_name, m1.monster_type, m1.danger_level, m1.created_date, m1.base_price,
            m1.status, m1.preserve_price) == ("Grim Reaper", "undead", 7, dt.date(2026, 1, 5),
                                              6371.0, "active", "$6,371.00")
    assert clean["M003"].base_price == 500.0 and clean["M003"].original_price_negative
    assert clean["M009"].base_price is None and not clean["M009"].original_price_negative
    q = {(r.monster_id, tuple(r.reasons)) for r in out.quarantine.collect()}
    assert q == {("M004", ("missing:monster_name",)), ("M005", ("missing:danger_level",)),
                 ("M006", ("missing:danger_level",)), ("M007", ("missing:created_date",)),
                 ("M008", ("duplicate",)), ("M008", ("duplicate",))}
    assert out.clean.columns == ["monster_id", "monster_name", "monster_type", "danger_level",
                                 "created_date", "base_price", "status", "preserve_date",
                                 "preserve_danger", "preserve_price", "original_price_negative",
                                 "duplicate_row"]


def test_tagged_partition_of_rows(raw):
    t = tagged_table(raw, MONSTER_SPEC)
    assert {r.outcome for r in t.collect()} == {"clean", "quarantine"}
    assert t.count() == 10


def test_steps_idempotent_except_dates(spark, raw):
    once = MONSTER_SPEC.upto("lower").apply(raw)
    again = Spec(MONSTER_SPEC.upto("lower").steps[1:]).apply(once)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_spec_validation():
    with pytest.raises(ValueError, match="unknown steps"):
        Spec((Step("explode_everything"),))
    assert ORDERS_SPEC.required() == ["customer_name", "created_date", "risk_level"]
    assert ORDERS_SPEC.flag() == "duplicate_row"
    assert ORDERS_SPEC.upto("trim").names() == ["normalize_headers", "trim"]


def test_ragged_line_kept_in_corrupt_column(spark):
    path = fresh_dir(spark, "ragged")
    os.makedirs(path)
    with open(os.path.join(path, "r.csv"), "w") as f:
        f.write("a,b\n1,2\n3,4,5\n")
    df = read_csv(spark, path, schema="a string, b string", corrupt_column="_bad")
    bad = [r._bad for r in df.collect()]
    assert bad.count(None) == 1 and "3,4,5" in bad


@pytest.mark.parametrize("null_safe,clean,quarantine,dups", [(False, 7142, 9358, 1072),
                                                             (True, 6428, 10072, 3000)])
def test_sf001_anchors(spark, null_safe, clean, quarantine, dups):
    from conftest import SF01
    from tablecare.operators.split import split_summary
    from tablecare.plans.fixtures import dirty_orders

    spec = ORDERS_SPEC.replace("flag_duplicates", null_safe=null_safe)
    flagged = spec.apply(dirty_orders(spark, SF01))
    s = split_summary(flagged, spec.required(), spec.flag()).collect()[0]
    assert (s.total_rows, s.clean_rows, s.quarantine_rows) == (16500, clean, quarantine)
    assert flagged.where("duplicate_row").count() == dups


def test_steps_table_lists_the_declared_order(spark):
    from tablecare.plans.spec import steps_table

    t = steps_table(spark, MONSTER_SPEC).orderBy("step_no").collect()
    assert [r.step for r in t] == MONSTER_SPEC.names()
    assert t[-1].columns == ["monster_name", "created_date", "danger_level"]
