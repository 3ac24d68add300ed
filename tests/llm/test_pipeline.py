import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
import reference as R
from conftest import SF, rows
from millrace.llm.common import source, written
from millrace.llm.mixing import copies
from millrace.llm.quality_rules import quality_report
from millrace.llm.queries import QUERIES

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage."""
    docs, out = source(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        after = written(stage(spark, docs, SF), "stage")
        out.append((name, docs, after))
        docs = after
    return out


@pytest.fixture(scope="module")
def exact():
    from millrace.llm.bpe import read_ranks

    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=read_ranks(C.RANKS), special_tokens={}).encode_ordinary


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(spark, stages):
    columns = source(spark, SF, "documents").columns
    assert len(stages) == 5
    assert all(after.columns == columns for _, _, after in stages[:-1])
    assert all(after.count() > 0 for _, _, after in stages)


def test_quality_rules(spark, stages):
    _, before, after = stages[0]
    kept = quality_report(before, source(spark, SF, "labels")).filter("kept").select("doc_id")
    assert rows(after.select("doc_id")) == rows(kept)
    assert not any(R.quality(t)["base_failed"] for _, t in texts(after))


def test_simhash(stages):
    _, before, after = stages[1]
    groups = R.simhash_groups(texts(before))
    assert sorted(i for i, _ in texts(after)) == sorted({c for _, _, c in groups})


def test_suffixes(stages):
    _, before, after = stages[2]
    want = {i: bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for i, b, gone in R.earlier_bytes(texts(before))}
    assert dict(texts(after)) == want


def test_mix(stages):
    _, before, after = stages[3]
    times = {r["doc_id"]: r["copies"] for r in copies(before).select("row.doc_id", "copies").collect()}
    got = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in times.items() if n}


def test_tokens(stages, exact):
    _, before, after = stages[4]
    want = sorted((i, exact(t)) for i, t in texts(before))
    got = after.collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want
    back = sorted((r["doc_id"], r["decoded_sha256"]) for r in got)
    assert back == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts(before))


def test_run_is_the_stages_in_turn(spark, stages):
    assert rows(C.run(spark, SF).select("doc_id", "n_tokens")) == rows(stages[-1][2].select("doc_id", "n_tokens"))


def test_digest_queries_equal_brute_force(spark, exact):
    docs = texts(source(spark, SF, "documents"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = rows(QUERIES["op4_byte_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    assert got == sorted((i, len(exact(t)), sha(np.array(exact(t), "<u4").tobytes()), sha(t.encode())) for i, t in docs)
    got = QUERIES["op6_suffix_array_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(got) == sorted(R.suffix_digest(docs))
    got = QUERIES["op9_simhash_near_dedup"](spark, SF).select("doc_id", "fingerprint", "component_id")
    assert rows(got) == sorted(R.simhash_groups(docs))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = QUERIES["op10_quality_rules"](spark, SF).select("doc_id", *names)
    assert rows(got) == sorted((i, *[R.quality(t)[n] for n in names]) for i, t in docs)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "embeddings", "conversations"):
        source(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, q in QUERIES.items():
        assert q(spark, str(tmp_path)).count() == 0, name
    assert C.run(spark, str(tmp_path)).count() == 0
