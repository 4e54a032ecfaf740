"""A recorded run of the source pipeline, read as data files.

``TABLECARE_RAW_CSV`` names its raw CSV and ``TABLECARE_RECORDED_RUN`` a folder
holding one recorded run (a ``*clean*.csv`` and a ``*quarantine*.csv``). The
raw file is cleaned with the monster step list and compared, as multisets,
with the recorded outputs. Skipped when the variables are not set.
"""

import csv
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablecare.operators.validate import validate_load
from tablecare.plans.spec import MONSTER_SPEC, clean_table
from tablecare.sources.files import read_csv

RAW = os.environ.get("TABLECARE_RAW_CSV", "")
RUN = os.environ.get("TABLECARE_RECORDED_RUN", "")

pytestmark = pytest.mark.skipif(not (os.path.isfile(RAW) and os.path.isdir(RUN)),
                                reason="no recorded run given")

INTS = {"danger_level"}
FLOATS = {"base_price"}
BOOLS = {"original_price_negative", "duplicate_row"}


def norm(col, v):
    if v is None or v == "":
        return None
    if col in INTS:
        return int(float(v))
    if col in FLOATS:
        return float(v)
    if col in BOOLS:
        return v in (True, "True")
    return str(v)


def recorded(name):
    (path,) = glob.glob(os.path.join(RUN, f"*{name}*.csv"))
    with open(path, newline="", encoding="utf-8") as f:
        rows = list(csv.DictReader(f))
    return Counter(tuple(norm(c, r[c]) for c in r) for r in rows), list(rows[0])


def ours(df, cols):
    return Counter(tuple(norm(c, str(r[c]) if c == "created_date" and r[c] is not None else r[c])
                         for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def split(spark):
    raw = read_csv(spark, RAW, infer=True)  # header plus type inference, as the source reads it
    return clean_table(raw, MONSTER_SPEC)


@pytest.mark.parametrize("name", ["clean", "quarantine"])
def test_matches_recorded_output(split, name):
    want, cols = recorded(name)
    got = ours(getattr(split, name), cols)
    assert list(getattr(split, name).columns) == cols
    assert sum(got.values()) == sum(want.values())
    assert got == want


def test_recorded_validation_numbers(spark, split):
    table = split.clean.withColumn("run_id", F.lit("r"))
    v = validate_load(table, "r", "monster_type", "status", "base_price").collect()[0]
    assert (v.clean_rows, v.distinct_types, v.distinct_statuses, v.average_price) == (84, 6, 4, 7712.86)
