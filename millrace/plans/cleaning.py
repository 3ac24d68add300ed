"""Queries on projection, cleaning, encoding and splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import any_rule, capitalise, days_since, map_values, parse_ts, rewrite_host
from millrace.operators.clean import (
    check_schema,
    drop_incomplete,
    fit_preprocess,
    normalise_columns,
    one_hot,
    rename_positional,
    select_signature,
)
from millrace.operators.split import hash_split, sample_fixed, sample_fraction, stratified_split, time_split
from millrace.plans.bindings import load, rounded
from millrace.plans.registry import query


@query(
    "project_rename",
    "SELECT o_orderkey AS id, o_custkey AS user_id, o_totalprice AS amount FROM orders",
)
def project_rename(spark, sf):
    rows = load(spark, sf, "orders").drop("o_orderdate", "o_orderstatus").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )
    return rename_positional(rows, ["id", "customer", "amount"]).withColumnsRenamed({"customer": "user_id"})


@query(
    "cast_columns",
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS amount, CAST(o_custkey AS DOUBLE) AS customer,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, TRY_CAST(o_orderpriority AS INTEGER) AS bad,
              CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority
       FROM orders""",
)
def cast_columns(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("int").alias("amount"),
        F.col("o_custkey").cast("double").alias("customer"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("priority"),
    )


@query(
    "normalise_columns",
    """SELECT c_custkey AS customer_id, c_mktsegment AS payment_method__auto_, c_nationkey AS streaming_tv,
              c_acctbal AS monthly_charges FROM customer""",
)
def normalise_columns_query(spark, sf):
    rows = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customerID"),
        F.col("c_mktsegment").alias("Payment Method (auto)"),
        F.col("c_nationkey").alias("StreamingTV"),
        F.col("c_acctbal").alias("Monthly-Charges"),
    )
    return normalise_columns(rows)


@query(
    "filter_compound",
    """SELECT doc_id, lang FROM documents
       WHERE (lang = 'en' AND n_chars > 1000) OR (lang <> 'en' AND length(text) <= 500 AND source IS NOT NULL)""",
)
def filter_compound(spark, sf):
    en = (F.col("lang") == "en") & (F.col("n_chars") > 1000)
    other = (F.col("lang") != "en") & (F.length("text") <= 500) & F.col("source").isNotNull()
    return load(spark, sf, "documents").filter(en | other).select("doc_id", "lang")


@query(
    "time_split",
    """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-23' THEN 'train' ELSE 'test' END AS split FROM events""",
)
def time_split_query(spark, sf):
    return time_split(load(spark, sf, "events"), "ts", "2024-01-23").select("event_id", "split")


@query(
    "drop_incomplete",
    """SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def drop_incomplete_query(spark, sf):
    """Documents whose label is known: the left join leaves gaps for the others."""
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    joined = docs.join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return drop_incomplete(joined)


@query(
    "map_labels",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS churn FROM orders""",
)
def map_labels(spark, sf):
    churn = map_values(F.col("o_orderstatus"), {"F": 1, "O": 0})
    return load(spark, sf, "orders").select("o_orderkey", churn.alias("churn"))


RULE_SQL = """
WITH o AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean,
                  count(*) FILTER (o_orderstatus = 'O') AS open
           FROM orders GROUP BY ALL)
SELECT o_custkey, 100 + CASE WHEN (n > 12 AND mean < 150000) OR 2 * open > n OR c_acctbal < -500 OR c_mktsegment IS NULL
       THEN 7 ELSE -3 END AS attention
FROM o JOIN customer ON o_custkey = c_custkey"""


@query("rule_score", RULE_SQL)
def rule_score(spark, sf):
    """Which customers an account manager should look at; joins on differently named keys."""
    orders = load(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"), F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("open")
    )
    rows = orders.join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    small_and_often = (F.col("n") > 12) & (F.col("mean") < 150_000)
    mostly_open = 2 * F.col("open") > F.col("n")
    signs = [small_and_often, mostly_open, F.col("c_acctbal") < -500, F.col("c_mktsegment").isNull()]
    return rows.select("o_custkey", any_rule(signs, 7, -3, 100).alias("attention"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]


@query(
    "one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderstatus = '{s}' AS BIGINT) AS o_orderstatus_{s.lower()}" for s in STATUSES)
    + ", "
    + ", ".join(
        f"CAST(o_orderpriority = '{p}' AS BIGINT) AS o_orderpriority_{n}"
        for p, n in [
            ("1-URGENT", "1_urgent"),
            ("2-HIGH", "2_high"),
            ("3-MEDIUM", "3_medium"),
            ("4-NOT SPECIFIED", "4_not_specified"),
            ("5-LOW", "5_low"),
        ]
    )
    + " FROM orders",
)
def one_hot_query(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    coded = one_hot(rows, ["o_orderstatus", "o_orderpriority"])
    return coded.toDF(*[c.replace(" ", "_").replace("-", "_").lower() for c in coded.columns])


@query(
    "impute_standardise",
    f"""WITH s AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance,
                          CAST(c_nationkey AS DOUBLE) AS nation FROM customer),
        m AS (SELECT avg(balance) AS mb, stddev_pop(balance) AS sb, avg(nation) AS mn, stddev_pop(nation) AS sn FROM s)
        SELECT c_custkey, round((coalesce(balance, mb) - mb) / sb, 6) AS balance,
               round((nation - mn) / sn, 6) AS nation,
               {", ".join(f"CAST(c_mktsegment = '{s}' AS BIGINT) AS segment_{s.lower()}" for s in SEGMENTS)}
        FROM s, m""",
)
def impute_standardise(spark, sf):
    """Fit on all customers: balances at or below zero count as missing, segments are coded."""
    rows = load(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.lower("c_mktsegment").alias("segment"),
    )
    out = fit_preprocess(rows, ["balance", "nation"], ["segment"]).transform(rows)
    return out.withColumns({c: F.round(c, 6) for c in ("balance", "nation")})


SIGNATURE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_orderpriority", T.IntegerType()),
        T.StructField("o_discount", T.DoubleType()),
    ]
)


@query(
    "schema_check",
    """WITH n AS (SELECT count(*) AS n_rows, count(*) FILTER (TRY_CAST(o_custkey AS INTEGER) IS NULL) AS bad,
                 count(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS bad_text FROM orders)
       SELECT 'o_orderkey' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, true AS present,
              true AS type_ok, n_rows, 0 AS n_bad FROM n
       UNION ALL SELECT 'o_totalprice', 'double', 'double', true, true, n_rows, 0 FROM n
       UNION ALL SELECT 'o_custkey', 'int', 'bigint', true, false, n_rows, bad FROM n
       UNION ALL SELECT 'o_orderpriority', 'int', 'string', true, false, n_rows, bad_text FROM n
       UNION ALL SELECT 'o_discount', 'double', NULL, false, false, n_rows, NULL FROM n""",
)
def schema_check(spark, sf):
    """Do the orders offer what a model expects? Three of the five inputs do not fit."""
    return check_schema(load(spark, sf, "orders"), SIGNATURE)


@query("signature_select", "SELECT o_orderkey, o_totalprice, CAST(o_custkey AS INTEGER) AS o_custkey FROM orders")
def signature_select(spark, sf):
    return select_signature(load(spark, sf, "orders"), T.StructType(SIGNATURE.fields[:3]))


def drawn_sql(seed: int, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 15))::BIGINT"


@query(
    "hash_split",
    f"""SELECT event_id, CASE WHEN {drawn_sql(42, 'event_id')} < 0.6::DOUBLE * pow(2, 60) THEN 'train'
          WHEN {drawn_sql(42, 'event_id')} < 0.8::DOUBLE * pow(2, 60) THEN 'val' ELSE 'test' END AS split FROM events""",
)
def hash_split_query(spark, sf):
    return hash_split(load(spark, sf, "events"), ["event_id"], {"train": 0.6, "val": 0.2, "test": 0.2}, 42).select(
        "event_id", "split"
    )


@query(
    "stratified_split",
    f"""SELECT event_id, event_type, CASE WHEN row_number() OVER (
            PARTITION BY event_type ORDER BY {drawn_sql(42, 'event_id')}, event_id)
          <= ceil(0.1::DOUBLE * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS split FROM events""",
)
def stratified_split_query(spark, sf):
    rows = load(spark, sf, "events").select("event_id", "event_type")
    return stratified_split(rows, "event_type", "event_id", 0.1, 42)


@query("sample_fixed", f"SELECT event_id, user_id FROM events ORDER BY {drawn_sql(42, 'event_id')}, event_id LIMIT 100")
def sample_fixed_query(spark, sf):
    return sample_fixed(load(spark, sf, "events"), "event_id", 100, 42).select("event_id", "user_id")


@query("sample_fraction", f"SELECT event_id FROM events WHERE {drawn_sql(42, 'event_id')} < 0.01::DOUBLE * pow(2, 60)")
def sample_fraction_query(spark, sf):
    return sample_fraction(load(spark, sf, "events"), ["event_id"], 0.01, 42).select("event_id")


@query(
    "pseudonymise",
    """SELECT c_custkey, sha1(lower(c_name) || '@example.com') AS email,
              list_aggregate(list_transform(string_split(lower(c_mktsegment || ' of ' || c_name), ' '),
                lambda w: upper(w[1:1]) || w[2:]), 'string_agg', ' ') AS name
       FROM customer""",
)
def pseudonymise(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey",
        F.sha1(F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.initcap(F.concat_ws(" of ", "c_mktsegment", "c_name")).alias("name"),
    )


@query(
    "rewrite_urls",
    """SELECT page_id, regexp_replace(url, 'https?://.*?/', 'https://shop.example/', 'g') AS url,
              upper(substr(title, 1, 1)) || lower(substr(title, 2)) AS title
       FROM (SELECT *, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages)""",
)
def rewrite_urls(spark, sf):
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return load(spark, sf, "pages").select(
        "page_id", rewrite_host(F.col("url"), "https://shop.example/").alias("url"), capitalise(title).alias("title")
    )


@query(
    "parse_timestamps",
    """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds, NULL::BIGINT AS none FROM orders""",
)
def parse_timestamps(spark, sf):
    """Dates written in two text layouts, depending on the order status, and read back."""
    us = F.date_format("o_orderdate", "MM-dd-yyyy HH:mm:ss")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("o_orderstatus") == "F", us).otherwise(iso)
    formats = ["MM-dd-yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss"]
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.unix_seconds(parse_ts(text, formats).cast("timestamp")).alias("seconds"),
        F.unix_seconds(parse_ts(F.col("o_orderpriority"), formats).cast("timestamp")).alias("none"),
    )


@query(
    "sorted_profile",
    """SELECT p_brand, p_type, count(*) AS n, round(max(p_retailprice), 2) AS top FROM part GROUP BY ALL
       ORDER BY p_brand, n DESC, p_type""",
)
def sorted_profile(spark, sf):
    out = load(spark, sf, "part").groupBy("p_brand", "p_type").agg(
        F.count("*").alias("n"), F.round(F.max("p_retailprice"), 2).alias("top")
    )
    return out.orderBy("p_brand", F.desc("n"), "p_type")


@query(
    "top_runs",
    """SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders
       ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_runs(spark, sf):
    out = load(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
    return out.select("o_orderkey", *rounded("o_totalprice", digits=2))
