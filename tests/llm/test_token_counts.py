import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from millrace.llm import token_counts as C

RANKS = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, section int"


def brute(values, rule, tokens):
    parts = [("source", (values[0] or "") + "\n"), ("lang", (values[1] or "") + "\n")] + [("text", x + "\n") for x in (values[2] or "").split("\n")]
    whole = "".join(p for _, p in parts)
    owner = [i for i, (_, p) in enumerate(parts) for _ in p]
    char_of = [c for c, ch in enumerate(whole) for _ in ch.encode()]
    count, crossing, at = [0.0] * len(parts), [0] * len(parts), 0
    for t in tokens.encode(whole):
        n = int(tokens.size[t])
        held = {}
        for c in sorted(set(char_of[at : at + n])):
            held[owner[c]] = held.get(owner[c], 0) + 1
        at += n
        if rule == "share":
            for s, k in held.items():
                count[s] += k / sum(held.values())
        else:
            count[min(held) if rule == "first" else max(held, key=lambda s: (held[s], -s))] += 1
        for s in held if len(held) > 1 else ():
            crossing[s] += 1
    out, start = [], 0
    for i, (name, p) in enumerate(parts):
        out.append((i, name, start, start + len(p), round(count[i], 6), crossing[i]))
        start += len(p)
    return out


@pytest.mark.parametrize("rule", C.RULES)
def test_equals_brute_force(spark, rule):
    rnd = random.Random(1)
    texts = [None, "", "\n\n\n", "one line", "a\n\n\n\nb  \n c", "é🙂日本\n🙂🙂\n", "x" * 5000 + "\n" * 300 + "y"]
    texts += ["".join(rnd.choice("ab \n\n日é.") for _ in range(rnd.randint(1, 200))) for _ in range(60)]
    rows = [(i, t, rnd.choice([None, "en"]), "src", 9) for i, t in enumerate(texts)] + [(None, "null id", "en", "s", 1), (0, None, "en", "src", 9)]
    tokens = C.Tokens(RANKS, P.PATTERN)
    want = sorted((str(i), *r) for i, t, la, s, _ in rows for r in brute((s, la, t), rule, tokens))
    out = C.section_tokens(spark.createDataFrame(rows, SCHEMA), RANKS, P.PATTERN, rule=rule)
    got = sorted((str(r[0]), *r[1:5], round(float(r[5]), 6), r[6]) for r in out.collect())
    assert got == want


def test_counts_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50)
    tokens = C.Tokens(RANKS, P.PATTERN)
    for rule in C.RULES:
        by_doc = C.section_tokens(docs, RANKS, P.PATTERN, rule=rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
        got = {r["doc_id"]: round(r["n"]) for r in by_doc.collect()}
        assert got == {r["doc_id"]: len(tokens.encode(f"{r['source']}\n{r['lang']}\n{r['text']}\n")) for r in docs.collect()}


def test_empty_and_unknown_rule(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.section_tokens(empty, RANKS, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        C.section_tokens(empty, RANKS, P.PATTERN, rule="last")
