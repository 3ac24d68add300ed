import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace.functions.columns import any_rule, capitalise, drawn_label, haversine_km, map_values, parse_ts
from millrace.operators.clean import (
    categories,
    check_schema,
    drop_incomplete,
    fit_preprocess,
    fit_scaler,
    normalise_columns,
    one_hot,
    snake_name,
)
from millrace.operators.split import hash_split, sample_fixed, sample_fraction, stratified_split


def test_names(spark):
    assert snake_name("StreamingTV", {"streaming_t_v": "streaming_tv"}) == "streaming_tv"
    assert snake_name("customerID") == "customer_id"
    assert snake_name("Payment Method (auto)") == "payment_method__auto_"
    with pytest.raises(ValueError, match="collide"):
        normalise_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def small(spark):
    data = [("x", 1.0, None), ("y", None, None), (None, 3.0, None), ("x", 5.0, None), ("z", 1.0, None), ("y", 2.0, None)]
    return spark.createDataFrame(data, "c string, n double, empty double")


def test_one_hot(spark):
    df = small(spark)
    out = one_hot(df.select("c"), ["c"])
    assert out.columns == ["c_x", "c_y", "c_z"]
    assert sorted(sum(r) for r in out.collect()) == [0, 1, 1, 1, 1, 1]
    assert one_hot(df.select("c"), ["c"], {"c": ["x", "q"]}).agg(F.sum("c_x"), F.sum("c_q")).first() == (2, 0)
    assert one_hot(df.select("c"), ["c"], drop_first=True).columns == ["c_y", "c_z"]
    with pytest.raises(ValueError, match="too many"):
        categories(spark.range(10).selectExpr("cast(id as string) c"), ["c"], limit=5)


def test_scaler(spark):
    df = small(spark)
    out = fit_scaler(df, ["n", "empty"]).transform(df).agg(
        F.round(F.avg("n"), 9), F.min("empty"), F.max("empty")
    ).first()
    assert out == (0.0, 0.0, 0.0)
    dirty = spark.createDataFrame([("1",), ("3",), ("bad",)], "n string")
    assert [r[0] for r in fit_scaler(dirty, ["n"]).transform(dirty).collect()] == [-1.0, 1.0, 0.0]
    both = fit_preprocess(df, ["n"], ["c"]).transform(df)
    assert both.columns == ["n", "empty", "c_x", "c_y", "c_z"]


def test_drop_map_parse(spark):
    df = small(spark)
    assert drop_incomplete(df).count() == 0
    assert drop_incomplete(df, ["c", "n"]).count() == 4
    mapped = df.select(map_values(F.col("c"), {"x": 1, "y": 0}).alias("m"))
    assert [r["m"] for r in mapped.collect()] == [1, 0, None, 1, None, 0]
    text = spark.createDataFrame([("01-31-2024 4:05:06",), ("2024-01-31 04:05:06",), ("31/01/2024",), (None,)], "t string")
    out = [str(r[0]) for r in text.select(parse_ts(F.col("t"), ["MM-dd-yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss"])).collect()]
    assert out == ["2024-01-31 04:05:06", "2024-01-31 04:05:06", "None", "None"]
    assert spark.range(1).select(capitalise(F.lit("hELLO wORLD"))).first()[0] == "Hello world"


def test_distance(spark):
    km = haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278))
    same = haversine_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0))
    got = spark.range(1).select(km, same).first()
    assert got[0] == pytest.approx(343.6, abs=1)
    assert got[1] == 0.0


def test_schema_check(spark):
    df = spark.createDataFrame([("1", 2), ("x", 3)], "a string, b long")
    want = T.StructType().add("a", T.IntegerType()).add("b", T.LongType()).add("c", T.DoubleType())
    got = {r["column_name"]: (r["present"], r["type_ok"], r["n_bad"]) for r in check_schema(df, want).collect()}
    assert got == {"a": (True, False, 1), "b": (True, True, 0), "c": (False, False, None)}


def test_splits_do_not_depend_on_layout(spark):
    df = spark.range(2000).withColumn("y", F.when(F.col("id") % 10 == 0, "rare").otherwise("common"))
    weights = {"base": 0.2, "t1": 0.5, "t2": 0.25, "t3": 0.05}
    one = hash_split(df, ["id"], weights, 42)
    assert rows(one) == rows(hash_split(df.repartition(9), ["id"], weights, 42))
    shares = {r["split"]: r["count"] / 2000 for r in one.groupBy("split").count().collect()}
    assert set(shares) == set(weights) and all(abs(shares[k] - weights[k]) < 0.05 for k in weights)
    tiny = hash_split(spark.range(300_000), ["id"], {"most": 1 - 0.00004, "few": 0.00004}, 42)
    assert 2 <= tiny.filter("split = 'few'").count() <= 40
    part = sample_fraction(df, ["id"], 0.1, 3)
    assert rows(part) == rows(sample_fraction(df.repartition(7), ["id"], 0.1, 3)) and 140 < part.count() < 260
    held = stratified_split(df, "y", "id", 0.1, 1)
    assert rows(held.filter("split = 'test'").groupBy("y").count()) == [("common", 180), ("rare", 20)]
    assert rows(held) == rows(stratified_split(df.repartition(3), "y", "id", 0.1, 1))
    assert held.count() == 2000
    assert rows(sample_fixed(df, "id", 17, 3)) == rows(sample_fixed(df.repartition(5), "id", 17, 3))


def test_rules_and_drawn_labels(spark):
    df = spark.range(1000).withColumn("n", F.when(F.col("id") % 2 == 0, F.col("id")))
    score = any_rule([F.col("n") > 500, F.col("id") == 1], 80, 20, 5)
    got = {r["s"]: r["count"] for r in df.groupBy(score.alias("s")).count().collect()}
    assert got == {85: 250, 25: 750}
    share = df.agg(F.avg(drawn_label(F.lit(30), F.col("id"), 1).cast("int"))).first()[0]
    assert 0.25 < share < 0.35
