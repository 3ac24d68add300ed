import pytest
from pyspark.sql import functions as F

from millrace.llm import quality_rules as Q
import reference as R

TEXTS = [
    None, "", "   \n\t", "one", "a b c d e f", "a b c d e a b c d e", "x " * 50, "# $ & | < >", "l\nl\n\n  \nl\nm",
    "The same five words here. " * 7, " no break é ñ 🙂 word", " ".join(f"w{i}" for i in range(20_000)),
    "a b a b a b a b a b a b", "\x0b\x0cx\ry", "word" * 5_000,
]


def table(spark, texts):
    rows = [(i, t, "en", "s", 1.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words double")


def test_counts_equal_plain_counts(spark):
    got = {r["doc_id"]: r.asDict() for r in Q.judged(Q.count_all(table(spark, TEXTS)), []).collect()}
    for i, t in enumerate(TEXTS):
        want = R.quality(t)
        assert {k: got[i][k] for k in want} == want, t and t[:40]
        assert got[i]["kept"] == (not want["base_failed"]) and got[i]["rule"] == 0


def labelled(spark, n=600):
    """Every third document is junk: many symbols, or hardly any lower-case letters."""
    rows = []
    for i in range(n):
        words = [f"wo{i}rd{j}" for j in range(30)]
        if i % 3 == 0:
            words = [w + "###" for w in words] if i % 2 else [w.upper() for w in words]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_rules_are_learned_and_generalise(spark):
    docs, labels = labelled(spark)
    out = Q.quality_report(docs, labels.filter("doc_id % 2 = 0 or doc_id % 3 = 0"))
    assert {r["doc_id"] for r in out.filter(~F.col("kept")).collect()} == set(range(0, 600, 3))
    assert out.select("rule").distinct().count() == 3  # none, and one rule for each kind of junk


def test_filter_keeps_columns_and_repeated_rows(spark):
    docs, labels = labelled(spark, 300)
    more = docs.union(docs.limit(20)).withColumns({"_stats": F.lit(1), "_rows": F.lit("x"), "rule": F.lit(2), "kept": F.lit(True)})
    out = Q.quality_filter(more, labels)
    assert out.columns == more.columns
    assert out.groupBy("doc_id").count().filter("doc_id % 3 = 0").count() == 0
    assert out.count() == 200 + more.limit(0).count() + docs.limit(20).filter("doc_id % 3 <> 0").count()


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_one_sided_labels_give_no_rules(spark, quality):
    docs, labels = labelled(spark, 60)
    one_sided = labels.withColumn("quality", F.lit(quality).cast("int"))
    assert Q.quality_report(docs, one_sided).filter("rule > 0").count() == 0


def test_empty_tables(spark):
    docs, labels = labelled(spark, 30)
    assert Q.quality_report(docs.limit(0), labels.limit(0)).count() == 0
    assert Q.quality_filter(docs, labels.limit(0)).count() == 30


def test_verdict_runs_no_python(spark):
    docs, labels = labelled(spark, 60)
    plan = Q.quality_filter(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
