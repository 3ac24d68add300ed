"""Queries on sources, sinks and table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.changes import delete_where, insert, latest_per_key, merge_upsert, pk_violations
from millrace.operators.clean import stamp
from millrace.operators.lookup import FeatureLookup
from millrace.plans.bindings import TRAVEL, load, rounded, travel
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.feature_store import FeatureStore
from millrace.sources.files import (
    create_table_as,
    read_csv,
    read_json,
    read_xml,
    append_table,
    replace_table,
    table,
    union_all,
    write_files,
    write_table,
)

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def _orders(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query(
    "scan_parquet",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
)
def scan_parquet(spark, sf):
    rows = load(spark, sf, "lineitem")
    late = rows.filter((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R"))
    return late.select("l_orderkey", "l_linenumber", "l_quantity")


@query("scan_csv", ORDERS_SQL)
def scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    write_files(_orders(spark, sf), path, "csv")
    return read_csv(spark, path, ORDERS)


@query("scan_json", ORDERS_SQL)
def scan_json(spark, sf):
    path = scratch_path(spark, "json")
    write_files(_orders(spark, sf), path, "json", 2)
    return read_json(spark, path, ORDERS)


@query(
    "scan_xml",
    """SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, length(text) AS body_length
       FROM conversations""",
)
def scan_xml(spark, sf):
    """Conversation turns written as XML rows with attributes, read back by row tag."""
    path = scratch_path(spark, "xml")
    rows = load(spark, sf, "conversations").select(
        F.col("conv_id").alias("_ConvId"), F.col("turn").alias("_Turn"), F.col("text").alias("_Body")
    )
    rows.write.format("xml").option("rowTag", "row").option("rootTag", "posts").save(path)
    back = read_xml(spark, path, "row", "_ConvId long, _Turn long, _Body string")
    return back.select(
        F.col("_ConvId").alias("conv_id"),
        F.col("_Turn").alias("turn"),
        F.length("_Body").cast("long").alias("body_length"),
    )


@query(
    "scan_table",
    """SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END AS c_nationkey FROM customer""",
)
def scan_table(spark, sf):
    """A catalog table, replaced with other columns, appended to with a new one, replaced from itself, and read by name."""
    path = scratch_path(spark, "table")
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    name = "millrace_" + path[-32:]
    replace_table(rows.limit(5), name, path)
    replace_table(rows.drop("c_nationkey").filter("c_custkey % 2 = 0"), name, path)
    append_table(rows.filter("c_custkey % 2 = 1"), name)  # brings a column
    create_table_as(spark, name, path, f"SELECT c_custkey, c_mktsegment, c_nationkey FROM {name}")
    return table(spark, name)


@query(
    "write_read_back",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
       FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
       GROUP BY o_orderstatus, o_orderpriority""",
)
def write_read_back(spark, sf):
    """Create a table from a query, append to it and read the partitioned result."""
    source, path = scratch_path(spark, "ctas"), scratch_path(spark, "appended")
    name = "millrace_" + source[-32:]
    created = create_table_as(spark, name, source, f"SELECT * FROM parquet.`{sf}/orders.parquet`")
    write_table(created, path, "overwrite", ["o_orderstatus"])
    back = write_table(created.filter("o_orderstatus = 'F'"), path, "append", ["o_orderstatus"])
    spark.sql(f"DROP TABLE {name}")
    return back.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "filtered_view",
    "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value > 50",
)
def filtered_view(spark, sf):
    load(spark, sf, "events").filter("event_type = 'purchase' AND value > 50").createOrReplaceTempView(
        "millrace_large_purchases"
    )
    return spark.sql("SELECT event_id, user_id FROM millrace_large_purchases")


KEYED = "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice"


def _keyed(df):
    return df.select("o_orderkey", "o_orderstatus", *rounded("o_totalprice", digits=2))


@query(
    "apply_insert",
    f"""{KEYED} FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL {KEYED} FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 100000""",
)
def apply_insert(spark, sf):
    rows = load(spark, sf, "orders")
    fresh = rows.filter("o_orderstatus = 'P' AND o_totalprice > 100000")
    return _keyed(insert(rows.filter("o_orderstatus <> 'P'"), fresh))


@query(
    "apply_delete",
    f"{KEYED} FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 200000)",
)
def apply_delete(spark, sf):
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)
    return _keyed(delete_where(load(spark, sf, "orders"), gone))


@query(
    "merge_upsert",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END, 2)
                AS o_totalprice
       FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'""",
)
def merge_upsert_query(spark, sf):
    """Urgent orders are merged, changed, into the finished ones: some replace rows, some are new."""
    rows = load(spark, sf, "orders")
    source = rows.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    return _keyed(merge_upsert(rows.filter("o_orderstatus = 'F'"), source, ["o_orderkey"]))


UPSERTED_SQL = f"""
WITH {TRAVEL},
hourly AS (SELECT user_id, date_trunc('hour', ts) AS hour, purchased, count(*) AS lookups, max(price) AS top_price
           FROM travel GROUP BY ALL)
SELECT user_id, strftime(hour, '%Y-%m-%d %H') AS hour, arg_max(lookups, purchased) AS lookups,
       round(arg_max(top_price, purchased), 4) AS top_price
FROM hourly GROUP BY user_id, hour"""


def _hourly(df):
    return df.groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("lookups"), F.max("price").alias("top_price")
    )


def _by_hour(store):
    return store.read_table("user_hours").select(
        "user_id", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "lookups", *rounded("top_price")
    )


@query("feature_upsert", UPSERTED_SQL)
def feature_upsert(spark, sf):
    """A feature table of look-ups per user and hour; hours with purchases are merged over it."""
    rows, store = travel(spark, sf), FeatureStore(spark, scratch_path(spark, "features"))
    store.create_table("user_hours", "user_id", "hour", df=_hourly(rows.filter("not purchased")))
    store.write_table("user_hours", _hourly(rows.filter("purchased")), mode="merge")
    return _by_hour(store)


@query("feature_merge_parts", UPSERTED_SQL)
def feature_merge_parts(spark, sf):
    """The same table in 64 parts by row key: the merge reads and rewrites the parts that its rows fall into."""
    rows, store = travel(spark, sf), FeatureStore(spark, scratch_path(spark, "features"))
    store.create_table("user_hours", "user_id", "hour", df=_hourly(rows.filter("not purchased")), parts=64)
    store.write_table("user_hours", _hourly(rows.filter("purchased")), mode="merge")
    return _by_hour(store)


STORE_LABELS = """
labels AS (SELECT event_id AS id, user_id, ts, event_type = 'purchase' AS bought FROM events WHERE event_id % 5 = 0),
features AS (SELECT user_id, CAST(ts AS DATE)::TIMESTAMP AS day, count(*) AS visits, max(value) AS top FROM events GROUP BY ALL),
found AS (
  SELECT l.id, l.user_id, l.bought, f.visits, f.top FROM labels l ASOF LEFT JOIN features f ON l.user_id = f.user_id AND l.ts >= f.day)"""


def _store(spark, sf):
    """A store with a daily table per user, and every fifth event as a label row."""
    events = load(spark, sf, "events")
    day = F.col("ts").cast("date").cast("timestamp_ntz").alias("day")
    daily = events.groupBy("user_id", day).agg(F.count("*").alias("visits"), F.max("value").alias("top"))
    store = FeatureStore(spark, scratch_path(spark, "features"))
    store.create_table("daily", "user_id", "day", df=daily)
    labels = events.filter("event_id % 5 = 0").select(F.col("event_id").alias("id"), "user_id", "ts", (F.col("event_type") == "purchase").alias("bought"))
    return store, labels, [FeatureLookup("daily", "user_id", ["visits", "top"], "ts")]


@query("store_training_set", f"WITH {STORE_LABELS} SELECT id, bought, visits, round(top, 4) AS top FROM found")
def store_training_set(spark, sf):
    """A training set on a table of the store, by its name."""
    store, labels, lookups = _store(spark, sf)
    return store.create_training_set(labels, lookups, "bought", ["user_id", "ts"]).load_df().withColumn("top", F.round("top", 4))


@query(
    "store_score_batch",
    f"WITH {STORE_LABELS} SELECT id, user_id, visits, round(1 / (1 + exp(-(0.25 * visits - 2))), 9) AS prediction FROM found",
)
def store_score_batch(spark, sf):
    """A model kept with its lookups scores rows of keys."""
    store, labels, lookups = _store(spark, sf)
    store.log_model("visits", store.create_training_set(labels, lookups, "bought", ["ts"]), "1 / (1 + exp(-(0.25D * visits - 2)))")
    out = store.score_batch("visits", labels.drop("bought"))
    return out.select("id", "user_id", "visits", F.round("prediction", 9).alias("prediction"))


@query(
    "pk_violations",
    """SELECT o_custkey, CAST(o_orderdate AS DATE)::VARCHAR AS day, count(*) AS n_rows FROM orders
       GROUP BY ALL HAVING count(*) > 1""",
)
def pk_violations_query(spark, sf):
    rows = load(spark, sf, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return pk_violations(rows, ["o_custkey", "day"])


@query(
    "serving_snapshot",
    f"""WITH {TRAVEL} SELECT destination_id, id, round(price, 4) AS price FROM
        (SELECT *, row_number() OVER (PARTITION BY destination_id ORDER BY ts DESC, id DESC) AS rn FROM travel)
        WHERE rn = 1""",
)
def serving_snapshot_query(spark, sf):
    """Publish the newest row per destination of a feature table and read the snapshot."""
    store = FeatureStore(spark, scratch_path(spark, "features"))
    rows = travel(spark, sf).select("destination_id", "ts", "id", "price")
    store.create_table("destinations", "destination_id", ["ts", "id"], df=rows)
    out = store.publish_table("destinations", scratch_path(spark, "snapshot"))
    return out.select("destination_id", "id", *rounded("price"))


@query(
    "latest_run",
    """SELECT o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders
       JOIN (SELECT o_orderpriority, max(o_orderdate) AS o_orderdate FROM orders GROUP BY ALL)
       USING (o_orderpriority, o_orderdate) GROUP BY o_orderpriority""",
)
def latest_run(spark, sf):
    """The newest order of every priority, as the newest run of a name."""
    rows = load(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    return latest_per_key(rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"]).select(
        "o_orderpriority", "o_orderkey"
    )


@query(
    "stamped_append",
    """SELECT loaded, o_orderstatus, count(*) AS n FROM (
         SELECT '2024-01-02 00:00:00' AS loaded, o_orderstatus FROM orders
         UNION ALL SELECT '2024-01-03 00:00:00', o_orderstatus FROM orders WHERE o_totalprice > 100000)
       GROUP BY ALL""",
)
def stamped_append(spark, sf):
    rows, path = load(spark, sf, "orders"), scratch_path(spark, "stamped")
    write_table(stamp(rows, "2024-01-02 00:00:00", "loaded_at"), path, "append")
    back = write_table(stamp(rows.filter("o_totalprice > 100000"), "2024-01-03 00:00:00", "loaded_at"), path, "append")
    return back.groupBy(
        F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded"), "o_orderstatus"
    ).agg(F.count("*").alias("n"))


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
       UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part""",
)
def union_all_query(spark, sf):
    def like(kind, table, key, balance):
        return load(spark, sf, table).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(balance).alias("balance"))

    return union_all(
        [
            like("customer", "customer", "c_custkey", "c_acctbal"),
            like("supplier", "supplier", "s_suppkey", "s_acctbal"),
            like("part", "part", "p_partkey", "p_retailprice"),
        ]
    )
