import json
import time
from datetime import datetime, timedelta

import pytest

from conftest import rows
from millrace.operators.changes import latest_per_key
from millrace.sources.feature_store import FeatureStore
from millrace.streaming.control import StreamGroup, drain_and_stop
from millrace.streaming.ingest import append_stream, hinted_schema, ingest_folder, read_folder, Refinement
from millrace.streaming.profile import LateRows, windowed_profile
from millrace.streaming.upsert import batches, newest, upsert_stream, write_batch

SCHEMA = "k long, t long, v string"


def put(folder, name, records, raw=()):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(r) for r in records] + list(raw)
    (folder / name).write_text("\n".join(lines) + "\n")
    time.sleep(0.02)  # files are taken in order of their times


def finish(query):
    assert query.awaitTermination(120)


def test_bronze_rescues_bad_lines_and_restarts(spark, scratch, tmp_path):
    landing, table, checkpoint = tmp_path / "in", scratch("bronze"), scratch("cp")
    put(landing, "a.json", [{"k": 1, "t": 1, "v": "x"}], raw=["{broken"])
    put(landing, "b.json", [{"k": 2, "t": 2, "v": "y", "more": 1}])
    finish(ingest_folder(spark, str(landing), "json", SCHEMA, table, checkpoint, max_files=1))
    put(landing, "c.json", [{"k": 3, "t": 3, "v": "z"}])
    finish(ingest_folder(spark, str(landing), "json", SCHEMA, table, checkpoint))
    finish(ingest_folder(spark, str(landing), "json", SCHEMA, table, checkpoint))
    out = spark.read.parquet(table)
    want = [(1, 1, "x", None), (2, 2, "y", '{"more":"1"}'), (3, 3, "z", None), (None, None, None, "{broken")]
    assert rows(out.select("k", "t", "v", "_rescued_data")) == want


def test_upsert_equals_batch_after_restart_and_replay(spark, scratch, tmp_path):
    landing, checkpoint = tmp_path / "in", scratch("cp")
    schema = spark.createDataFrame([], SCHEMA).schema
    path, keys, order = scratch("upsert"), ["k"], ["t"]
    assert newest(spark, path, schema, keys, order).isEmpty()
    put(landing, "a.json", [{"k": 1, "t": 5, "v": "new"}, {"k": 2, "t": 1, "v": "b"}, {"k": 2, "t": 1, "v": "b"}])
    put(landing, "b.json", [{"k": 1, "t": 3, "v": "late"}, {"k": 3, "t": 1, "v": "c"}])
    df = read_folder(spark, str(landing), "json", SCHEMA, max_files=1).drop("_rescued_data")
    finish(upsert_stream(df, path, keys, order, checkpoint, "ups"))
    want = [(1, 5, "new"), (2, 1, "b"), (3, 1, "c")]
    assert rows(newest(spark, path, schema, keys, order)) == want
    # The same batch once more, as after a failure, changes nothing.
    write_batch(spark.createDataFrame([(1, 3, "late"), (3, 1, "c")], SCHEMA), path, keys, order, 1)
    assert rows(newest(spark, path, schema, keys, order)) == want and batches(spark, path, schema).count() == 4
    put(landing, "c.json", [{"k": 2, "t": 9, "v": "B"}])
    df = read_folder(spark, str(landing), "json", SCHEMA).drop("_rescued_data")
    served = scratch("served")
    finish(upsert_stream(df, path, keys, order, checkpoint, "ups", publish=(served, keys, order)))
    every = spark.read.schema(SCHEMA).json(str(landing))
    assert rows(newest(spark, path, schema, keys, order)) == rows(latest_per_key(every, ["k"], ["t"]))
    assert rows(newest(spark, served, schema, keys, order)) == [(2, 9, "B")]


def test_new_columns_come_in_on_restart(spark, scratch, tmp_path):
    landing, table, checkpoint = tmp_path / "in", scratch("bronze"), scratch("cp")
    put(landing, "a.json", [{"k": 1, "day": "2024-01-01"}])
    for step in (1, 2):
        schema = hinted_schema(spark, str(landing), "json", "day date, k int")
        finish(ingest_folder(spark, str(landing), "json", schema, table, checkpoint))
        if step == 1:
            put(landing, "b.json", [{"k": 2, "day": "2024-01-02", "extra": 5.5}])
    out = spark.read.option("mergeSchema", True).parquet(table)
    got = [(r["k"], str(r["day"]), r["extra"]) for r in out.orderBy("k").collect()]
    assert got == [(1, "2024-01-01", None), (2, "2024-01-02", 5.5)]
    assert dict(out.dtypes)["k"] == "int"


def test_feature_table_fed_by_stream(spark, scratch, tmp_path):
    store, landing, checkpoint = FeatureStore(spark, scratch("store")), tmp_path / "in", scratch("cp")
    store.create_table("f", "k", "t", df=spark.createDataFrame([(1, 1, "base"), (9, 1, "base")], SCHEMA))
    put(landing, "a.json", [{"k": 1, "t": 1, "v": "first"}, {"k": 1, "t": 2, "v": "x"}])
    for name, record in (("b.json", {"k": 1, "t": 1, "v": "second"}), (None, None)):
        df = read_folder(spark, str(landing), "json", SCHEMA).drop("_rescued_data")
        finish(store.write_stream("f", df, checkpoint))
        if name:
            put(landing, name, [record])
    want = [(1, 1, "second"), (1, 2, "x"), (9, 1, "base")]
    assert rows(store.read_table("f")) == want
    assert rows(store.publish_table("f", scratch("snap"))) == [(1, 2, "x"), (9, 1, "base")]
    with pytest.raises(ValueError, match="stream"):
        store.write_table("f", spark.createDataFrame([], SCHEMA))


def test_late_rows_are_dropped_and_counted(spark, scratch, tmp_path):
    landing = tmp_path / "in"
    t0 = datetime(2024, 1, 1)

    def record(minutes, v):
        return {"ts": (t0 + timedelta(minutes=minutes)).isoformat(), "v": v, "c": "a"}

    put(landing, "a.json", [record(0, 1.0), record(3, 2.0)])
    put(landing, "b.json", [record(100, 5.0)])
    # Lateness is judged by the watermark of the batch before, so one more batch has to pass.
    put(landing, "c.json", [record(102, 0.0)])
    put(landing, "d.json", [record(1, 9.0), record(101, 1.0)])
    put(landing, "e.json", [record(500, 0.0)])
    df = read_folder(spark, str(landing), "json", "ts timestamp, v double, c string", max_files=1)
    out = windowed_profile(df, "ts", "10 minutes", "20 minutes", "v", ["c"])
    table, late = scratch("windows"), LateRows()
    spark.streams.addListener(late)
    query = append_stream(out, table, scratch("cp"))
    finish(query)
    got = spark.read.parquet(table).orderBy("window_start").collect()
    assert [(r["count"], r["sum"]) for r in got] == [(2, 3.0), (3, 6.0)]
    assert late.of(query) == 1
    spark.streams.removeListener(late)
    batch = windowed_profile(
        spark.read.schema("ts timestamp, v double, c string").json(str(landing)), "ts", "10 minutes", "20 minutes", "v", ["c"]
    )
    assert batch.count() == 3


def test_refinement(spark):
    df = spark.createDataFrame([("o", "u", "01-31-2024 10:00:00", 2.0, 30.0, None)], "id string, user_id string, transaction_date string, item_count double, amount double, _rescued_data string")
    clock = {"transaction_date": ["MM-dd-yyyy HH:mm:ss"]}
    tidy = Refinement(times=clock, casts={"amount": "int", "item_count": "int"}, renamed={"id": "order_id", "transaction_date": "at"})
    out = tidy(df)
    assert out.columns == ["order_id", "user_id", "at", "item_count", "amount"]
    row = out.first()
    assert (row["order_id"], row["amount"], row["item_count"], str(row["at"])) == ("o", 30, 2, "2024-01-31 10:00:00")


def test_equal_keys_in_a_batch_have_one_answer(spark, scratch):
    schema = spark.createDataFrame([], SCHEMA).schema
    for order in ([(1, 1, "a"), (1, 1, "b")], [(1, 1, "b"), (1, 1, "a")]):
        path = scratch("ties")
        write_batch(spark.createDataFrame(order, SCHEMA), path, ["k"], ["t"], 0)
        assert rows(newest(spark, path, schema, ["k"], ["t"])) == [(1, 1, "b")]


def test_control(spark, scratch, tmp_path):
    put(tmp_path / "in", "a.json", [{"k": 1, "t": 1, "v": "x"}])
    df = read_folder(spark, str(tmp_path / "in"), "json", SCHEMA)

    def start(name):
        return append_stream(df, scratch("out"), scratch("cp"), name, {"processingTime": "1 second"})

    one, two = start("ctl_one"), start("ctl_two")
    group = StreamGroup(spark, "ctl_")
    assert set(group.running()) == {"ctl_one", "ctl_two"}
    with pytest.raises(TimeoutError):
        group.wait(timeout=1)
    drain_and_stop(one)
    assert group.end(timeout=30) == 1
    assert not group.running()
    assert not two.isActive
