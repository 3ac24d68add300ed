"""Queries that run a stream over the given tables until it has caught up."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.bindings import TRAVEL, load, rounded, travel
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.feature_store import FeatureStore
from millrace.sources.files import write_files
from millrace.streaming.ingest import Refinement, append_stream, ingest_folder, read_folder, refine_table
from millrace.streaming.profile import windowed_profile
from millrace.streaming.upsert import newest, upsert_stream

EVENT_FILE = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DEADLINE = 900


def _finish(stream):
    if not stream.awaitTermination(DEADLINE):
        stream.stop()
        raise TimeoutError("stream did not catch up")


def _land(spark, df, fmt, files=4):
    path = scratch_path(spark, "landing")
    write_files(df, path, fmt, files)
    return path


@query("stream_files", "SELECT event_id, user_id, event_type, round(value, 4) AS value FROM events")
def stream_files(spark, sf):
    """Events as JSON files, streamed two files at a time."""
    folder = _land(spark, load(spark, sf, "events"), "json")
    out = scratch_path(spark, "streamed")
    df = read_folder(spark, folder, "json", EVENT_FILE, max_files=2)
    _finish(append_stream(df, out, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", *rounded("value"))


@query(
    "stream_bronze",
    """SELECT user_id, count(*) AS n, round(sum(value), 3) AS total, count(*) FILTER (event_type = 'click') AS clicks,
              CAST(0 AS BIGINT) AS rescued FROM events GROUP BY user_id""",
)
def stream_bronze(spark, sf):
    """Events as CSV files into a bronze table, read as one batch."""
    folder = _land(spark, load(spark, sf, "events"), "csv")
    table = scratch_path(spark, "bronze")
    _finish(ingest_folder(spark, folder, "csv", EVENT_FILE, table, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(table).groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.round(F.sum("value"), 3).alias("total"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"),
        F.count("_rescued_data").alias("rescued"),
    )


@query(
    "stream_rescued",
    """SELECT event_id, user_id, '{"event_type":"' || event_type || '"}' AS rescued FROM events""",
)
def stream_rescued(spark, sf):
    """Events as JSON files with a field that the schema does not name."""
    folder = _land(spark, load(spark, sf, "events").select("event_id", "user_id", "event_type"), "json")
    out = scratch_path(spark, "streamed")
    _finish(append_stream(read_folder(spark, folder, "json", "event_id long, user_id long"), out, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(out).select("event_id", "user_id", F.col("_rescued_data").alias("rescued"))


USER_FILE = (
    "id string, firstname string, lastname string, email string, creation_date string, last_activity_date string, "
    "gender double, age_group double, churn boolean"
)


CLOCK = ["MM-dd-yyyy HH:mm:ss"]
SILVER_USERS = Refinement(
    hashed=["email"],
    capitalised=["firstname", "lastname"],
    times={"creation_date": CLOCK, "last_activity_date": CLOCK},
    casts={"age_group": "int", "gender": "int", "churn": "int"},
    renamed={"id": "user_id"},
)


@query(
    "stream_silver",
    """SELECT CAST(c_custkey AS VARCHAR) AS user_id, upper(c_name[1:1]) || lower(c_name[2:]) AS firstname,
              upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) AS lastname,
              sha1(c_name || '@example.com') AS email,
              strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d') AS created,
              CAST(c_nationkey % 2 AS INTEGER) AS gender, CAST(c_nationkey % 10 AS INTEGER) AS age_group,
              CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS churn
       FROM customer""",
)
def stream_silver(spark, sf):
    """Customers as JSON users: files to bronze to silver, both as streams."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("c_custkey", F.lit(28)).cast("int"))
    text = F.date_format(day.cast("timestamp_ntz"), "MM-dd-yyyy HH:mm:ss")
    users = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("firstname"),
        F.col("c_mktsegment").alias("lastname"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        text.alias("creation_date"),
        text.alias("last_activity_date"),
        F.pmod("c_nationkey", F.lit(2)).cast("double").alias("gender"),
        F.pmod("c_nationkey", F.lit(10)).cast("double").alias("age_group"),
        (F.col("c_acctbal") < 0).alias("churn"),
    )
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    _finish(ingest_folder(spark, _land(spark, users, "json"), "json", USER_FILE, bronze, scratch_path(spark, "checkpoint")))
    schema = T.StructType.fromDDL(USER_FILE + ", _rescued_data string")
    _finish(refine_table(spark, bronze, schema, SILVER_USERS, silver, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(silver).select(
        "user_id",
        "firstname",
        "lastname",
        "email",
        F.date_format("creation_date", "yyyy-MM-dd").alias("created"),
        "gender",
        "age_group",
        "churn",
    )


AVAILABILITY = "destination_id int, booking_date date, ts timestamp_ntz, id long, price double"


@query(
    "stream_upsert",
    f"""WITH {TRAVEL} SELECT destination_id, CAST(booking_date AS VARCHAR) AS booking_date, id, round(price, 4) AS price
        FROM (SELECT *, row_number() OVER (PARTITION BY destination_id, booking_date ORDER BY ts DESC, id DESC) AS rn
              FROM travel) WHERE rn = 1""",
)
def stream_upsert(spark, sf):
    """Availability rows as JSON files, merged by destination and date, and published from the stream."""
    rows = travel(spark, sf).select("destination_id", "booking_date", "ts", "id", "price")
    folder = _land(spark, rows, "json")
    keys, order, published = ("destination_id", "booking_date"), ("ts", "id"), scratch_path(spark, "published")
    df = read_folder(spark, folder, "json", AVAILABILITY, max_files=2)
    _finish(upsert_stream(df, scratch_path(spark, "upsert"), keys, order, scratch_path(spark, "checkpoint"), publish=(published, keys, order)))
    out = newest(spark, published, rows.schema, keys, order)
    return out.select("destination_id", F.col("booking_date").cast("string").alias("booking_date"), "id", *rounded("price"))


@query(
    "store_publish_stream",
    """SELECT user_id, event_id, round(value, 4) AS value FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def store_publish_stream(spark, sf):
    """Events stream into a feature table, and each batch publishes its newest row per user."""
    rows = load(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    store = FeatureStore(spark, scratch_path(spark, "features"))
    store.create_table("latest", "user_id", ["ts", "event_id"], schema=rows.schema)
    df = read_folder(spark, _land(spark, rows, "json"), "json", rows.schema, max_files=2)
    served = scratch_path(spark, "served")
    _finish(store.write_stream("latest", df, scratch_path(spark, "checkpoint"), publish=served))
    return store.read_published("latest", served).select("user_id", "event_id", *rounded("value"))


@query(
    "stream_profile",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS "count", round(sum(value), 3) AS sum,
              min(value) AS min, max(value) AS max FROM events GROUP BY ALL""",
)
def stream_profile(spark, sf):
    """Daily profile per event type, updated by every micro-batch; a window's state leaves a day after its end."""
    folder, events = scratch_path(spark, "landing"), load(spark, sf, "events")
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()  # one row
    edges = [span["lo"] + (span["hi"] - span["lo"]) * i / 4 for i in range(1, 4)] if span["lo"] else []
    part = sum((F.col("ts") >= F.lit(e).cast("timestamp_ntz")).cast("int") for e in edges) if edges else F.lit(0)
    for i in range(len(edges) + 1):  # files land in the order of their rows' times
        events.filter(F.coalesce(part, F.lit(0)) == i).coalesce(1).write.mode("append").json(folder)
    df = read_folder(spark, folder, "json", EVENT_FILE.replace("timestamp_ntz", "timestamp"), max_files=1)
    profiled = windowed_profile(df, "ts", "1 day", "1 day", "value", ["event_type"])
    path, keys, order = scratch_path(spark, "profile"), ("window_start", "event_type"), ("count",)
    _finish(upsert_stream(profiled, path, keys, order, scratch_path(spark, "checkpoint"), output_mode="update"))
    return newest(spark, path, profiled.schema, keys, order).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "count",
        *rounded("sum", digits=3),
        "min",
        "max",
    )
