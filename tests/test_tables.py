import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.changes import delete_where, latest_per_key, merge_upsert, pk_violations
from millrace.operators.clean import stamp
from millrace.sources.feature_store import FeatureStore
from millrace.sources.files import date_range, from_rows, list_tables, read_csv, read_json, wait_for_rows, write_files, write_table
from millrace.functions.columns import seeded_uniform, split_tags, surrogate_id


def kv(spark, data):
    return spark.createDataFrame(data, "k long, v string")


def test_merge_replaces_and_adds(spark):
    target = kv(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = kv(spark, [(2, "B"), (3, "c"), (None, "m")])
    merged = merge_upsert(target, source, ["k"])
    assert rows(merged) == [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]
    again = merge_upsert(merge_upsert(target, source.filter("k is not null"), ["k"]), source.filter("k is not null"), ["k"])
    assert rows(again.filter("k is not null")) == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_rejects_duplicate_source_keys(spark):
    with pytest.raises(Exception, match="several rows for key"):
        merge_upsert(kv(spark, [(1, "a")]), kv(spark, [(1, "x"), (1, "y")]), ["k"]).select("k").collect()


def test_delete_keeps_unknown(spark):
    df = kv(spark, [(1, "a"), (2, None), (3, "b")])
    assert rows(delete_where(df, F.col("v") == "a")) == [(2, None), (3, "b")]


def test_latest_and_violations(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 9, "y"), (2, 1, None)], "k long, t long, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 9, "y"), (2, 1, None)]
    assert rows(pk_violations(df, ["k"])) == [(1, 2)]


def test_feature_store(spark, scratch):
    store = FeatureStore(spark, scratch("store"))
    first = spark.createDataFrame([(1, 10, 1.0), (1, 20, 2.0), (2, 10, 3.0)], "k long, t long, v double")
    with pytest.raises(ValueError, match="missing"):
        store.create_table("bad", "nope", df=first)
    store.create_table("f", "k", "t", schema=first.schema, description="d", tags={"team": "x"})
    assert store.read_table("f").isEmpty()
    store.write_table("f", first, mode="overwrite")
    store.write_table("f", spark.createDataFrame([(1, 20, 9.0), (3, 5, 4.0)], first.schema))
    assert rows(store.read_table("f")) == [(1, 10, 1.0), (1, 20, 9.0), (2, 10, 3.0), (3, 5, 4.0)]
    assert store.violations("f").isEmpty()
    spec = store.get_table("f")
    assert (spec.primary_keys, spec.timestamp_keys, spec.tags["team"]) == (("k",), ("t",), "x")
    assert rows(store.publish_table("f", scratch("snap"))) == [(1, 20, 9.0), (2, 10, 3.0), (3, 5, 4.0)]
    with pytest.raises(ValueError, match="exists"):
        store.create_table("f", "k", df=first)
    assert store.list_tables() == ["f"]
    store.drop_table("f")
    with pytest.raises(KeyError):
        store.read_table("f")
    store.create_table("f", "k", df=first.filter("t = 10"))
    assert store.read_table("f").count() == 2


def test_files(spark, scratch):
    df = from_rows(spark, [(1, "a,b"), (2, None)], "id long, s string")
    for fmt, read in (("csv", read_csv), ("json", read_json)):
        path = scratch(fmt)
        write_files(df, path, fmt, 2)
        assert rows(read(spark, path, "id long, s string")) == [(1, "a,b"), (2, None)]


def test_append_merges_schema(spark, scratch):
    path = scratch("grow")
    write_table(from_rows(spark, [(1,)], "a long"), path)
    out = write_table(from_rows(spark, [(2, "x")], "a long, b string"), path, "append")
    assert rows(out) == [(1, None), (2, "x")]


def test_ranges_and_keys(spark):
    days = [str(r["date"]) for r in date_range(spark, "2024-02-28", 3).orderBy("date").collect()]
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]
    ids = spark.range(1000).select(surrogate_id(F.col("id")).alias("s"), seeded_uniform(F.col("id"), 1).alias("u"))
    again = spark.range(1000).repartition(7).select(surrogate_id(F.col("id")).alias("s"), seeded_uniform(F.col("id"), 1).alias("u"))
    assert rows(ids) == rows(again)
    assert 0.4 < ids.agg(F.avg("u")).first()[0] < 0.6
    assert split_tags("senior, gender_female,,") == ["senior", "gender_female"]
    assert split_tags(None) == []


def test_stamp_and_catalog(spark):
    df = stamp(spark.range(2), "2024-05-01 10:00:00", "at")
    assert {str(r["at"]) for r in df.collect()} == {"2024-05-01 10:00:00"}
    df.createOrReplaceTempView("millrace_probe_x")
    assert list_tables(spark, "millrace_probe_*") == ["millrace_probe_x"]
    assert wait_for_rows(lambda: spark.table("millrace_probe_x"), 5).count() == 2
    with pytest.raises(TimeoutError):
        wait_for_rows(lambda: spark.table("millrace_no_such_table"), 0.1, 0.05)


def test_keys_are_checked(spark, scratch):
    from millrace.sources.feature_store import FeatureStore

    store = FeatureStore(spark, scratch("store"))
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(Exception, match="several rows"):
        store.create_table("t", "k", df=twice)
    assert store.list_tables() == []
    store.create_table("t", "k", df=twice.limit(1))
    with pytest.raises(Exception, match="several rows"):
        store.write_table("t", twice, mode="overwrite")
    assert store.read_table("t").count() == 1


def test_two_writers_of_one_version_are_noticed(spark, scratch):
    from millrace.sources.register import COLUMNS, Register

    register = Register(spark, scratch("register"))
    register.put("a", "{}", "x")
    spark.createDataFrame([("a", 0, "{}", "y")], COLUMNS).write.mode("append").parquet(f"{register.root}/_register")
    with pytest.raises(Exception, match="two writers"):
        register.find("a")


def test_a_failed_replacement_keeps_the_table(spark, scratch):
    from millrace.sources.files import append_table, create_table_as, replace_table

    name, base = "millrace_replaced", scratch("replaced")
    for n in (3, 2):
        assert create_table_as(spark, name, base, f"SELECT id FROM range({n})").count() == n
    with pytest.raises(Exception):
        create_table_as(spark, name, base, "SELECT raise_error('no') AS id")
    assert spark.table(name).count() == 2
    out = append_table(spark.createDataFrame([("x", 9)], "more string, id long"), name)
    assert sorted(map(str, out.collect())) == ["Row(id=0, more=None)", "Row(id=1, more=None)", "Row(id=9, more='x')"]
    replace_table(spark.createDataFrame([(1.5,)], "other double"), name, base)
    assert spark.table(name).columns == ["other"]
    spark.sql(f"DROP TABLE {name}")
