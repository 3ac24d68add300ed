"""The test tables in the roles the operators expect, in Spark and as SQL for the check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds
from millrace.sources.files import scan


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as travel look-ups: who asked for which destination, at what price, bought or not."""
    ts, user = F.col("ts"), F.col("user_id")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        ts,
        epoch_seconds(ts).alias("sec"),
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("destination_id"),
        F.col("value").alias("price"),
        (F.col("event_type") == "click").alias("clicked"),
        (F.col("event_type") == "purchase").alias("purchased"),
        F.to_date(ts).alias("booking_date"),
        (F.pmod(user * 37, F.lit(160)) - 80).cast("double").alias("user_latitude"),
        (F.pmod(user * 73, F.lit(340)) - 170).cast("double").alias("user_longitude"),
    )


TRAVEL = """
travel AS (
  SELECT event_id AS id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec, user_id,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS destination_id,
         value AS price, event_type = 'click' AS clicked, event_type = 'purchase' AS purchased,
         CAST(ts AS DATE) AS booking_date,
         CAST((user_id * 37) % 160 - 80 AS DOUBLE) AS user_latitude,
         CAST((user_id * 73) % 340 - 170 AS DOUBLE) AS user_longitude
  FROM events)"""


def locations(travel_df: DataFrame) -> DataFrame:
    """One made-up but fixed place per destination that occurs."""
    d = F.col("destination_id")
    return travel_df.select("destination_id").distinct().select(
        "destination_id",
        (F.pmod(d * 53, F.lit(170)) - 85).cast("double").alias("latitude"),
        (F.pmod(d * 97, F.lit(350)) - 175).cast("double").alias("longitude"),
    )


LOCATIONS = """
locations AS (
  SELECT DISTINCT destination_id, CAST((destination_id * 53) % 170 - 85 AS DOUBLE) AS latitude,
         CAST((destination_id * 97) % 350 - 175 AS DOUBLE) AS longitude
  FROM travel)"""


def rounded(*names: str, digits: int = 4) -> list[Column]:
    return [F.round(F.col(n), digits).alias(n) for n in names]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a closed-form score, a prediction and two segment columns."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    score = F.round(F.col("n_chars") / (F.col("n_chars") + 2000.0), 3)
    return (
        docs.join(labels, "doc_id")
        .withColumn("score", score)
        .withColumn("predicted", (F.col("score") >= 0.4).cast("int"))
    )


SCORED = """
scored AS (
  SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic,
         round(d.n_chars / (d.n_chars + 2000.0::DOUBLE), 3) AS score,
         CASE WHEN round(d.n_chars / (d.n_chars + 2000.0::DOUBLE), 3) >= 0.4 THEN 1 ELSE 0 END AS predicted
  FROM documents d JOIN labels l USING (doc_id))"""
