import pytest
from pyspark.sql import functions as F

from tablecare.functions.text import Rule, categorize, short_name


def test_categorize_first_hit_wins(spark):
    rules = [Rule("exact", "None", "void"), Rule("set", ("Self", "typing.Self"), "self"),
             Rule("contains", "List[", "list"), Rule("prefix", "<class '", "object")]
    df = spark.createDataFrame([("None",), ("Self",), ("typing.List[int]",), ("<class 'str'>",),
                                ("weird",), (None,)], "v string")
    got = [r[0] for r in df.select(categorize("v", rules, "object", "not_annotated")).collect()]
    assert got == ["void", "self", "list", "object", "object", "not_annotated"]


def test_rule_kind_checked():
    with pytest.raises(ValueError):
        Rule("regex", "x", "y")


def test_short_name(spark):
    vals = ["<class 'pkg.storage.FileClient'>", "typing.Optional[typing.Any]",
            "a.b.C", "plain", "None", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(short_name(F.col("v"))).collect()]
    assert got == ["FileClient", "Optional[Any]", "C", "plain", "None", None]


def test_annotation_categories(spark):
    from tablecare.functions.text import categorize_annotation

    cases = [(None, "not_annotated"), ("None", "void"), ("Self", "self"),
             ("<class 'int'>", "primitive"), ("typing.Dict[str, int]", "dictionary"),
             ("List[str]", "list"), ("typing.Tuple[int, int]", "tuple"),
             ("Iterator[bytes]", "iterator"), ("ItemPaged[Props]", "paged_collection"),
             ("typing.Union[str, NoneType]", "union"), ("<class 'pkg.Thing'>", "object"),
             ("whatever", "object"), ("typing.Optional[typing.List[int]]", "list")]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v string")
    got = [r[0] for r in df.select(categorize_annotation(F.col("v"))).collect()]
    assert got == [want for _, want in cases]
