from tablecare.operators.usage import usage_index


def test_usage_index_cuts_examples_before_collecting(spark):
    data = [("path", "str", f"m{i:02d}") for i in range(30)] + [("path", "bytes", "m00"),
                                                              ("name", "str", "z"), ("name", None, None)]
    df = spark.createDataFrame(data, "key string, t string, owner string")
    idx = {r.key: r for r in usage_index(df, "key", "t", "owner").collect()}
    assert idx["path"].used == 31 and idx["path"].types == ["bytes", "str"]
    assert idx["path"].examples == [f"m{i:02d}" for i in range(10)] and idx["path"].more == 20
    assert idx["name"].used == 2 and idx["name"].types == ["str"] and idx["name"].examples == ["z"] and idx["name"].more == 0


def test_usage_index_plan_limits_per_key_before_shuffle(spark):
    df = spark.createDataFrame([("k", "t", str(i)) for i in range(50)], "key string, t string, owner string")
    plan = usage_index(df, "key", "t", "owner")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_usage_index_type_cut_keeps_exact_count(spark):
    data = [("k", f"t{i:03d}", "o") for i in range(40)] + [("j", None, "o")]
    df = spark.createDataFrame(data, "key string, t string, owner string")
    idx = {r.key: r for r in usage_index(df, "key", "t", "owner", max_types=5).collect()}
    assert idx["k"].types == [f"t{i:03d}" for i in range(5)] and idx["k"].type_count == 40
    assert idx["j"].types == [] and idx["j"].type_count == 0
