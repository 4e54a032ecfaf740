"""Declared cleaning steps, compiled to DataFrame transforms.

A ``Spec`` is an ordered list of ``Step(name, columns, options)``. Each step is
one projection (or, for ``flag_duplicates``, the duplicate operator), so the
whole list compiles to a short chain that Catalyst collapses into one
``Project`` below the duplicate aggregation. The list is the code: what it says
is what runs (the ``null_check`` step names every required column and decides
the split).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.functions import columns as C
from tablecare.operators import frames
from tablecare.operators.duplicates import flag_duplicates
from tablecare.operators.split import quarantine_rows, clean_rows, reasons, with_outcome


@dataclass(frozen=True)
class Step:
    name: str
    columns: tuple[str, ...] = ()
    options: Mapping = field(default_factory=dict)


StepFn = Callable[[DataFrame, Step], DataFrame]


def _cols(df: DataFrame, step: Step, default: Callable[[DataFrame], list[str]]) -> list[str]:
    return list(step.columns) if step.columns else default(df)


def _per_column(fn: Callable) -> StepFn:
    def run(df: DataFrame, step: Step) -> DataFrame:
        return frames.map_columns(df, _cols(df, step, frames.string_columns), fn)
    return run


def _preserve(df: DataFrame, step: Step) -> DataFrame:
    names = step.options.get("names") or {c: f"preserve_{c}" for c in step.columns}
    return frames.preserve_columns(df, {c: names[c] for c in step.columns})


def _flag_negative(df: DataFrame, step: Step) -> DataFrame:
    (src,) = step.columns
    out = step.options.get("out", f"original_{src}_negative")
    return df.withColumn(out, C.is_negative(F.col(f"`{src}`")))


def _flag_unparsable(df: DataFrame, step: Step) -> DataFrame:
    (src,) = step.columns
    out = step.options.get("out", f"unparsable_{src}")
    return df.withColumn(out, F.col(f"`{step.options['original']}`").isNotNull() & F.col(f"`{src}`").isNull())


def _dates(df: DataFrame, step: Step) -> DataFrame:
    formats = tuple(step.options.get("formats", C.DATE_FORMATS))
    return frames.map_columns(df, step.columns, lambda c: C.parse_date(c, formats))


def _range(df: DataFrame, step: Step) -> DataFrame:
    low = step.options.get("low", C.LEVEL_RANGE[0])
    high = step.options.get("high", C.LEVEL_RANGE[1])
    return frames.map_columns(df, step.columns, lambda c: C.in_range(c, low, high))


def _duplicates(df: DataFrame, step: Step) -> DataFrame:
    opts = dict(step.options)
    return flag_duplicates(df, keys=list(step.columns) or None,
                           flag=opts.get("flag", "duplicate_row"),
                           null_safe=opts.get("null_safe", False),
                           keep=opts.get("keep", "none"), order=opts.get("order", ()),
                           method=opts.get("method", "staged"))


def _null_check(df: DataFrame, step: Step) -> DataFrame:
    unknown = set(step.columns) - set(df.columns)
    if unknown:
        raise ValueError(f"null_check names unknown columns: {sorted(unknown)}")
    return df  # the rule is applied by the split


STEPS: dict[str, StepFn] = {
    "normalize_headers": lambda df, step: frames.normalize_headers(df),
    "trim": _per_column(C.trim_spaces),
    "blank_to_null": _per_column(C.blank_to_null),
    "upper": _per_column(C.case_upper),
    "initcap": _per_column(C.case_title),
    "lower": _per_column(C.case_lower),
    "preserve_original": _preserve,
    "clean_currency": _per_column(C.clean_currency),
    "try_cast_double": _per_column(C.try_double),
    "flag_negative": _flag_negative,
    "flag_unparsable": _flag_unparsable,
    "fix_negative": _per_column(C.fix_negative),
    "try_parse_date": _dates,
    "try_cast_int": _per_column(C.try_int),
    "range_check": _range,
    "flag_duplicates": _duplicates,
    "null_check": _null_check,
}


@dataclass(frozen=True)
class Spec:
    steps: tuple[Step, ...]

    def __post_init__(self):
        unknown = [s.name for s in self.steps if s.name not in STEPS]
        if unknown:
            raise ValueError(f"unknown steps: {unknown}")

    def names(self) -> list[str]:
        return [s.name for s in self.steps]

    def required(self) -> list[str]:
        return [c for s in self.steps if s.name == "null_check" for c in s.columns]

    def rejects(self) -> list[str]:
        """Columns of ``flag_unparsable`` steps: their rows go to quarantine."""
        return [s.options.get("out", f"unparsable_{s.columns[0]}") for s in self.steps
                if s.name == "flag_unparsable"]

    def flag(self) -> str | None:
        for s in self.steps:
            if s.name == "flag_duplicates":
                return s.options.get("flag", "duplicate_row")
        return None

    def upto(self, name: str) -> "Spec":
        """The steps up to and including the first step called ``name``."""
        idx = self.names().index(name)
        return Spec(self.steps[: idx + 1])

    def replace(self, name: str, **options) -> "Spec":
        return Spec(tuple(Step(s.name, s.columns, {**s.options, **options}) if s.name == name else s
                          for s in self.steps))

    def apply(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = STEPS[step.name](df, step)
        return df


class Split(NamedTuple):
    clean: DataFrame
    quarantine: DataFrame


def split(flagged: DataFrame, spec: Spec, with_reasons: bool = False) -> Split:
    checks = spec.required(), spec.flag(), spec.rejects()
    q = quarantine_rows(flagged, *checks)
    if with_reasons:
        q = q.withColumn("reasons", reasons(*checks))
    return Split(clean_rows(flagged, *checks), q)


def clean_table(df: DataFrame, spec: Spec, with_reasons: bool = False) -> Split:
    """The whole cleaning transform: steps, duplicate flag, then the split."""
    return split(spec.apply(df), spec, with_reasons)


def tagged_table(df: DataFrame, spec: Spec, out: str = "outcome") -> DataFrame:
    """Steps applied and each row tagged ``clean``/``quarantine`` (one table, one pass)."""
    return with_outcome(spec.apply(df), spec.required(), spec.flag(), out, spec.rejects())


def steps_table(spark, spec: Spec) -> DataFrame:
    """The declared list as a small table (step number, name, columns)."""
    rows = [(i, s.name, list(s.columns)) for i, s in enumerate(spec.steps, start=1)]
    return spark.createDataFrame(rows, "step_no int, step string, columns array<string>")


# Column roles of the source pipeline's table and its declared steps.
MONSTER_SPEC = Spec((
    Step("normalize_headers"),
    Step("trim"),
    Step("blank_to_null"),
    Step("upper", ("monster_id",)),
    Step("initcap", ("monster_name",)),
    Step("lower", ("monster_type", "status")),
    Step("preserve_original", ("created_date", "danger_level", "base_price"),
         {"names": {"created_date": "preserve_date", "danger_level": "preserve_danger",
                    "base_price": "preserve_price"}}),
    Step("clean_currency", ("base_price",)),
    Step("try_cast_double", ("base_price",)),
    Step("flag_negative", ("base_price",), {"out": "original_price_negative"}),
    Step("fix_negative", ("base_price",)),
    Step("try_parse_date", ("created_date",)),
    Step("try_cast_int", ("danger_level",)),
    Step("range_check", ("danger_level",), {"low": 1, "high": 10}),
    Step("flag_duplicates", (), {"flag": "duplicate_row"}),
    Step("null_check", ("monster_name", "created_date", "danger_level")),
))

# The same steps with the roles of the ``dirty_orders`` fixture.
ORDERS_SPEC = Spec((
    Step("normalize_headers"),
    Step("trim"),
    Step("blank_to_null"),
    Step("upper", ("order_id",)),
    Step("initcap", ("customer_name",)),
    Step("lower", ("order_type", "status")),
    Step("preserve_original", ("created_date", "risk_level", "base_price"),
         {"names": {"created_date": "preserve_date", "risk_level": "preserve_level",
                    "base_price": "preserve_price"}}),
    Step("clean_currency", ("base_price",)),
    Step("try_cast_double", ("base_price",)),
    Step("flag_negative", ("base_price",), {"out": "original_price_negative"}),
    Step("fix_negative", ("base_price",)),
    Step("try_parse_date", ("created_date",)),
    Step("try_cast_int", ("risk_level",)),
    Step("range_check", ("risk_level",), {"low": 1, "high": 10}),
    Step("flag_duplicates", (), {"flag": "duplicate_row"}),
    Step("null_check", ("customer_name", "created_date", "risk_level")),
))

