"""Queries on calendars, sinks, ids, catalog helpers, column hooks, models in SQL and monitors by name."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.columns import seeded_uniform, split_tags, surrogate_id
from millrace.operators import corpus
from millrace.operators.model import register_sql, train
from millrace.operators.profile import Monitor
from millrace.operators.split import hash_split
from millrace.plans.bindings import SCORED, load, scored
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.files import append_table, date_range, from_rows, list_tables, read_csv, read_json, replace_table, wait_for_rows, write_files
from millrace.sources.monitors import MonitorStore
from millrace.streaming.control import StreamGroup, drain_and_stop
from millrace.streaming.ingest import read_folder


@query(
    "calendar_counts",
    """SELECT CAST(d AS DATE)::VARCHAR AS day, count(event_id) AS n
       FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)
       LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY ALL""",
)
def calendar_counts(spark, sf):
    """Events of each calendar day from the first to the last, days without any included."""
    events = load(spark, sf, "events").select(F.col("ts").cast("date").alias("date"), "event_id")
    span = events.agg(F.min("date").alias("first"), F.datediff(F.max("date"), F.min("date")).alias("days")).first()  # one row
    days = date_range(spark, str(span["first"] or "1970-01-01"), span["days"] + 1 if span["first"] else 0).join(events, "date", "left")
    return days.groupBy(F.col("date").cast("string").alias("day")).agg(F.count("event_id").alias("n"))


WEIGHTS = [("1-URGENT", 8), ("2-HIGH", 5), ("3-MEDIUM", 3), ("5-LOW", None)]


@query(
    "rows_in_memory",
    """SELECT o_orderpriority, w.weight, count(*) AS n, CAST(sum(w.weight) AS BIGINT) AS total FROM orders
       LEFT JOIN (VALUES ('1-URGENT', 8), ('2-HIGH', 5), ('3-MEDIUM', 3), ('5-LOW', NULL)) w(priority, weight) ON priority = o_orderpriority
       GROUP BY ALL""",
)
def rows_in_memory(spark, sf):
    """Orders weighed by a table typed in as rows; a priority that it lacks has no weight."""
    weights = from_rows(spark, WEIGHTS, "o_orderpriority string, weight int")
    orders = load(spark, sf, "orders").select("o_orderpriority").join(weights, "o_orderpriority", "left")
    return orders.groupBy("o_orderpriority", "weight").agg(F.count("*").alias("n"), F.sum("weight").alias("total"))


@query(
    "seeded_columns",
    """SELECT c_mktsegment, count(*) AS n, true AS spread, true AS again, true AS apart FROM customer GROUP BY ALL""",
)
def seeded_columns(spark, sf):
    """Random columns by key and seed: evenly spread, the same on another layout, and different for another seed."""
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    one, two = (seeded_uniform(F.col("c_custkey"), seed) for seed in (1, 2))
    made = rows.withColumns({"one": one, "two": two})
    other = rows.repartition(5, "c_mktsegment").select(F.col("c_custkey").alias("key"), one.alias("same"))
    both = made.join(other, F.col("c_custkey") == F.col("key"))
    n, mean = F.count("*"), F.avg("one")
    return both.groupBy("c_mktsegment").agg(
        n.alias("n"),
        (F.abs(mean - 0.5) < 5 * 0.2887 / F.sqrt(n)).alias("spread"),  # five standard errors
        F.bool_and(F.col("one") == F.col("same")).alias("again"),
        (F.count(F.when(F.col("one") == F.col("two"), 1)) == 0).alias("apart"),
    )


@query("stream_control", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_control(spark, sf):
    """Two streams under one name: one drained and stopped, the other ended with its group; the drained one saw every row."""
    events = load(spark, sf, "events").select("event_id", "event_type")
    folder = scratch_path(spark, "landing")
    write_files(events, folder, "json", 3)
    shape = "event_id long, event_type string"
    name = "millrace_" + folder[-12:]
    paths = [scratch_path(spark, "controlled") for _ in range(2)]
    started = []
    for i, path in enumerate(paths):
        writer = read_folder(spark, folder, "json", shape).writeStream.queryName(f"{name}_{i}").format("parquet")
        started.append(writer.option("path", path).option("checkpointLocation", scratch_path(spark, "checkpoint")).start())
    group = StreamGroup(spark, name)
    if set(group.running()) != {f"{name}_0", f"{name}_1"}:
        raise RuntimeError("the group does not hold its streams")
    drain_and_stop(started[0])
    if group.end(120) != 1 or group.running():
        raise RuntimeError("a stream of the group still runs")
    return spark.read.schema(shape).parquet(paths[0]).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "file_sinks",
    """SELECT k AS kind, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders, (VALUES ('csv'), ('json')) AS f(k) GROUP BY ALL""",
)
def file_sinks(spark, sf):
    """Orders written as CSV and as JSON in three files each, and read back."""
    rows, shape = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey long, o_orderstatus string, o_totalprice double"
    out = None
    for fmt, read in (("csv", read_csv), ("json", read_json)):
        path = scratch_path(spark, "sink")
        write_files(rows, path, fmt, 3)
        back = read(spark, path, shape).select(F.lit(fmt).alias("kind"), "*")
        out = back if out is None else out.unionByName(back)
    return out.groupBy("kind", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("surrogate_ids", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, true AS stable FROM events")
def surrogate_ids(spark, sf):
    """Ids are as many as keys, and the same on another layout."""
    rows = load(spark, sf, "events").select("event_id", "user_id")
    made, again = (df.select(surrogate_id(F.col("event_id"), F.col("user_id")).alias("id")) for df in (rows, rows.repartition(7, "user_id")))
    mark = F.sum(F.col("id").cast("decimal(38,0)"))
    return made.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), (mark == again.agg(mark.alias("s")).scalar()).alias("stable"))


@query("tagged_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def tagged_columns(spark, sf):
    """The columns that a comma-separated tag names."""
    return load(spark, sf, "customer").select(*split_tags("c_custkey, c_mktsegment,"))


@query(
    "catalog_helpers",
    """SELECT 2 AS listed, (SELECT count(*) FROM nation) + (SELECT count(*) FROM nation WHERE n_regionkey = 1) AS n FROM region LIMIT 1""",
)
def catalog_helpers(spark, sf):
    """Tables found by pattern, and one waited for until it has rows."""
    base = scratch_path(spark, "catalog")
    prefix = "millrace_c" + base[-12:]
    nations = load(spark, sf, "nation")
    replace_table(nations, f"{prefix}_a", base)
    replace_table(nations.limit(0), f"{prefix}_b", base)
    append_table(nations.filter("n_regionkey = 1"), f"{prefix}_b")
    found = [n for n in list_tables(spark, f"{prefix}*")]
    rows = wait_for_rows(lambda: spark.table(f"{prefix}_b"), 30).unionByName(spark.table(f"{prefix}_a"))
    return rows.agg(F.lit(len(found)).alias("listed"), F.count("*").alias("n"))


@query(
    "model_hooks",
    """SELECT doc_id, CASE WHEN length(text) > 5000 THEN md5(text) ELSE text END AS by_series,
              CASE WHEN length(text) > 5000 THEN 'short:' || md5(text) ELSE text END AS by_iterator,
              md5(text) AS digest, length(text) AS size FROM documents""",
)
def model_hooks(spark, sf):
    """Series, iterator and struct-returning functions over whole texts in the place of a model."""

    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: hashlib.md5(t.encode()).hexdigest(), na_action="ignore")

    @F.pandas_udf("string")
    def by_series(texts: pd.Series) -> pd.Series:
        return digest(texts)

    @F.pandas_udf("string")
    def by_iterator(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = "short:"  # what a model would load once per task
        for texts in batches:
            yield model + digest(texts)

    @F.pandas_udf("digest string, size long")
    def by_struct(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame({"digest": digest(texts), "size": texts.str.len()})

    docs = load(spark, sf, "documents").select("doc_id", "text")
    out = corpus.shorten(docs, "text", hook=by_series, name="by_series")
    out = corpus.shorten(out, "text", hook=by_iterator, name="by_iterator").withColumn("found", by_struct("text"))
    return out.select("doc_id", "by_series", "by_iterator", "found.digest", "found.size")


@query(
    "model_in_sql",
    f"""WITH {SCORED}, t AS (SELECT doc_id, quality FROM scored
        WHERE ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT >= 0.8::DOUBLE * pow(2, 60))
        SELECT doc_id, kind, true AS same FROM t, (VALUES ('gbt'), ('logistic')) AS k(kind)""",
)
def model_in_sql(spark, sf):
    """Logistic and boosted-tree models give in SQL what they give as models."""
    rows = scored(spark, sf).select("doc_id", "score", (F.col("lang") == "en").cast("double").alias("is_en"), "quality")
    rows = hash_split(rows, ["doc_id"], {"train": 0.6, "val": 0.2, "test": 0.2}, 42)
    out = None
    for kind in ("gbt", "logistic"):
        best = train(rows, ["score", "is_en"], "quality", "split", [{"maxIter": 5}], kind)
        register_sql(spark, f"millrace_{kind}", best)
        both = best.transform(rows.filter("split = 'test'")).withColumn("by_sql", F.expr(f"millrace_{kind}(score, is_en)"))
        part = both.select("doc_id", F.lit(kind).alias("kind"), (F.abs(F.col("by_sql") - F.col("probability")) < 1e-9).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "monitor_lifecycle",
    """SELECT column_name, n FROM (
         SELECT ':table' AS column_name, count(*) AS n FROM orders UNION ALL SELECT 'o_totalprice', count(*) FROM orders
         UNION ALL SELECT 'o_orderkey', count(*) FROM orders)""",
)
def monitor_lifecycle(spark, sf):
    """A monitor created, changed and refreshed, beside one that is deleted."""
    tables = {"orders": load(spark, sf, "orders"), "gone": load(spark, sf, "nation")}
    store = MonitorStore(spark, scratch_path(spark, "monitors"), tables.__getitem__)
    store.create_or_update(Monitor("orders", ("o_totalprice",)), "2024-01-01")
    store.create_or_update(Monitor("gone", ("n_nationkey",)), "2024-01-01")
    store.delete("gone")
    store.update("orders", columns=("o_totalprice", "o_orderkey"))
    store.refresh("orders", "2024-01-02")
    newest = store.analysis("orders").filter(F.to_date("window_start") == F.lit("2024-01-02").cast("date"))
    return newest.select("column_name", F.col("count").alias("n"))
