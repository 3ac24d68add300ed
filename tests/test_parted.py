"""Tables merged part by part, and lookups that leave the table where it lies."""

import random
import re
from datetime import datetime, timedelta
from pathlib import Path
from uuid import uuid4

import pytest

from conftest import rows
from millrace.operators.changes import merge_upsert
from millrace.operators.lookup import point_in_time
from millrace.sources.feature_store import FeatureStore
from millrace.sources.parted import BucketedFeatures, PartedTable

T0 = datetime(2024, 1, 1)


def files(path):
    """Name and time of every data file, by part."""
    out = {}
    for f in Path(path).glob("_part=*/*.parquet"):
        out.setdefault(int(f.parent.name.split("=")[1]), []).append((f.name, f.stat().st_mtime_ns))
    return {k: sorted(v) for k, v in out.items()}


@pytest.fixture
def table(spark, scratch):
    first = spark.createDataFrame([(i, f"n{i}", i * 1.5) for i in range(400)], "k long, name string, v double")
    made = PartedTable(spark, scratch("parted"), first.schema, ["k"], 32)
    made.create(first)
    return made, first


def test_a_merge_of_few_keys_rewrites_their_parts_only(spark, table):
    made, first = table
    change = spark.createDataFrame([(7, "new", None), (1000, None, 2.0), (8, "x", 1.0)], first.schema)
    want = rows(merge_upsert(first, change, ["k"]))
    before = files(made.path)
    touched = made.merge(change.withColumnRenamed("v", "V").withColumnRenamed("V", "v"))
    after = files(made.path)
    assert 1 <= len(touched) <= 3 and len(before) == 32
    assert {p for p in after if after[p] != before.get(p)} == set(touched)
    assert rows(made.read()) == want
    assert made.read().columns == ["k", "name", "v"]
    made.merge(change)  # the same merge again changes no row
    assert rows(made.read()) == want


def test_only_touched_parts_are_read(spark, table):
    made, first = table
    old = made._stored().filter("_part IN (3, 5)").drop("_part")
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or re.search(r"PartitionFilters: \[.*_part.*\(3,5\)", plan)


def test_types_nulls_repeats_empty(spark, scratch, table):
    made, first = table
    made.merge(spark.createDataFrame([(9, "nine", 9, "more")], "k int, name string, v int, extra string"))
    assert made.read().filter("k = 9").collect() == [(9, "nine", 9.0)]
    made.merge(first.limit(0))
    assert made.read().count() == 400
    made.merge(spark.createDataFrame([(None, "a", 1.0), (None, "b", 2.0)], first.schema))
    assert made.read().filter("k is null").count() == 2
    with pytest.raises(Exception, match="several rows for key"):
        made.merge(spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], first.schema))
    assert made.read().count() == 402
    with pytest.raises(ValueError, match="columns missing"):
        made.merge(first.drop("v"))
    empty = PartedTable(spark, scratch("parted"), first.schema, ["k"], 4)
    empty.create(first.limit(0))
    assert empty.read().count() == 0
    empty.merge(first.limit(3))
    assert empty.read().count() == 3
    for bad in (dict(keys=["none"], parts=4), dict(keys=["k"], parts=0)):
        with pytest.raises(ValueError):
            PartedTable(spark, scratch("parted"), first.schema, **bad)


def test_store_keeps_parts(spark, scratch):
    first = spark.createDataFrame([(i, T0 + timedelta(hours=i), i) for i in range(200)], "k long, ts timestamp_ntz, v long")
    store = FeatureStore(spark, scratch("features"))
    store.create_table("hours", "k", "ts", df=first, parts=16)
    folder = store.register.require("hours")["folder"]
    before = files(folder)
    change = spark.createDataFrame([(3, T0 + timedelta(hours=3), -1), (3, T0, 5)], first.schema)
    store.write_table("hours", change)
    after = files(folder)
    assert store.get_table("hours").parts == 16 and store.register.require("hours")["folder"] == folder
    assert 1 <= sum(after[p] != before.get(p) for p in after) <= 2
    assert rows(store.read_table("hours")) == rows(merge_upsert(first, change, ["k", "ts"]))
    store.write_table("hours", change, mode="overwrite")
    assert rows(store.read_table("hours")) == rows(change)


def labels_and_features(spark):
    draw = random.Random(5)
    at = lambda: None if draw.random() < 0.05 else T0 + timedelta(seconds=draw.randrange(5000))
    # a third of the labels and of the features share one key
    key = lambda: draw.choice([1, draw.randrange(40), None if draw.random() < 0.2 else draw.randrange(40)])
    left = [(i, key(), at()) for i in range(600)]
    seen = {(key(), at()): draw.random() if draw.random() < 0.9 else None for _ in range(900)}
    right = [(k, t, v) for (k, t), v in seen.items()]
    return (
        spark.createDataFrame(left, "id long, u long, ts timestamp_ntz"),
        spark.createDataFrame(right, "k long, ts timestamp_ntz, v double"),
    )


def bucketed(spark, scratch, features, **more):
    table = BucketedFeatures(spark, f"t_{uuid4().hex}", scratch("buckets"), ["k"], "ts", **more)
    table.create(features)
    return table


@pytest.mark.parametrize("per_task", [5_000_000, 60])
def test_bucketed_lookup_equals_point_in_time(spark, scratch, per_task):
    labels, features = labels_and_features(spark)
    table = bucketed(spark, scratch, features, rows_per_task=per_task)
    want = rows(point_in_time(labels, features, {"u": "k"}, "ts", "ts", ["v"]))
    got = table.lookup(labels, {"u": "k"}, "ts", ["v"])
    assert got.columns == ["id", "u", "ts", "v"] and rows(got) == want
    narrow = labels.withColumn("u", labels["u"].cast("int"))
    assert rows(table.lookup(narrow, {"u": "k"}, "ts", ["v"])) == want
    busy = spark.read.parquet(table._busy).count()
    assert busy == (0 if per_task > 1000 else 1)
    assert table.read().count() == features.dropna(subset=["k", "ts"]).count()


def test_the_table_does_not_move(spark, scratch):
    labels, features = labels_and_features(spark)
    table = bucketed(spark, scratch, features, buckets=6)
    out = table.lookup(labels, {"u": "k"}, "ts", ["v"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Bucketed: true" in plan
    # above the scan of the table, up to the union with the labels, nothing is exchanged; above the union nothing either
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    lines = plan.splitlines()
    above, depth = [], len(lines[scan]) - len(lines[scan].lstrip(" :|+-"))
    for line in reversed(lines[:scan]):
        here = len(line) - len(line.lstrip(" :|+-"))
        if here < depth:
            above, depth = [*above, line], here
    assert any("Union" in line for line in above) and not any("Exchange" in line for line in above)


def test_bucketed_edges(spark, scratch):
    labels, features = labels_and_features(spark)
    empty = bucketed(spark, scratch, features.limit(0))
    out = rows(empty.lookup(labels, {"u": "k"}, "ts", ["v"]))
    assert len(out) == 600 and all(r[-1] is None for r in out)
    table = bucketed(spark, scratch, features)
    assert table.lookup(labels.limit(0), {"u": "k"}, "ts", ["v"]).count() == 0
    with pytest.raises(ValueError, match="already present"):
        table.lookup(labels.withColumnRenamed("id", "v"), {"u": "k"}, "ts", ["v"])
    with pytest.raises(ValueError, match="bucketed by"):
        table.lookup(labels, {"u": "other"}, "ts", ["v"])
    twice = features.unionByName(features.filter("k is not null and ts is not null").limit(1))
    with pytest.raises(Exception, match="several rows for one time"):
        bucketed(spark, scratch, twice).lookup(labels, {"u": "k"}, "ts", ["v"]).collect()
    with pytest.raises(ValueError, match="tiles of time"):
        point_in_time(labels, features, {"u": "k"}, "ts", "ts", ["v"], 5, None, 4)
