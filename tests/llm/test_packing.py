import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from conftest import SF
from millrace.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, length string, piece int"


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def texts(n=300, seed=4):
    rnd = random.Random(seed)
    letters = ["a", "B", "th", "É", "ß", "ſ", "İ", "Σ", "ς", "é", "漢", "🙂", "'s", "'LL", "’t", "9", "½", "_", "-", "«", "\x1c", "\x85", "\xa0", "　", "\x00", "×", "ŉ", "ﬁ", "K"]
    odd = ["".join(rnd.choice(letters + [" ", "\n", "\t", "\x0b"]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return odd + ["", " \n", "x" * 30_000, "ab1 " * 4000, "<|endoftext|> <|startoftext|>x", "don't stop'ing THE world's"]


def test_ids_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(P, "CHUNKS", 200)  # the table starts anew on the way
    encoder, plain = P.Encoder(PATH), library()
    every = texts()
    for at in range(0, len(every), 20):
        part = every[at : at + 20]
        ids, n = encoder.encode(pa.array(part, pa.large_string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in part]


def test_every_common_letter_goes_the_short_way():
    encoder, plain = P.Encoder(PATH), library()
    for code in [*range(33, 127), *range(0xA1, 0x180), *range(0x2010, 0x2030)]:
        for text in (chr(code), f"a{chr(code)}B'{chr(code)}1"):
            ids, _ = encoder.encode(pa.array([text], pa.large_string()))
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, hex(code)


def check(rows, docs, size, plain):
    """Pieces hold all ids of all rows, sequences are gapless and not too long; the number of sequences."""
    want = collections.Counter()
    total = 0
    for doc_id, text in docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for piece in range(-(-len(ids) // size)):
            part = ids[piece * size : (piece + 1) * size]
            want[doc_id, piece, piece * size, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    used = collections.defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(used), -(-total // size)


@pytest.mark.parametrize("steps, size", [(P.STEPS, 4096), (5, 64), (40, 500)])
def test_packs_all_rows(spark, steps, size):
    docs = [(i, t) for i, t in enumerate(texts(80))] + [(None, "lost"), (None, None), (3, "again"), (3, "again")]
    table = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], SCHEMA).repartition(5)
    rows = P.packed(table, PATH, size, steps=steps, keep_ids=True).collect()
    made, least = check(rows, docs, size, library())
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert made <= least * 1.1 + 2


def test_the_query_needs_hardly_more_than_the_least(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = entry.queries()["op11_best_fit_packing"](spark, SF).collect()
    made, least = check(rows, docs, 4096, library())
    assert made <= least + 1


def squares(counts, length, size):
    """Sums of squares after each possible choice, in plain Python."""
    out = {}
    for gap in [g for g in counts if g >= length and counts[g]] or [size]:
        after = collections.Counter(counts)
        if gap < size:
            after[gap] -= 1
        if gap > length:
            after[gap - length] += 1
        out[gap] = sum(n * n for n in after.values())
    return out


def test_each_choice_makes_the_squares_least():
    rnd, size = random.Random(1), 30
    packer, counts = P.Packer(size), collections.Counter()
    for _ in range(400):
        length = rnd.randint(1, size - 1)
        gap, ways = packer._gap(length, 1), squares(counts, length, size)
        assert gap in ways and ways[gap] == min(ways.values())
        packer.add(length, 0, 1)
        if gap < size:
            counts[gap] -= 1
        if gap > length:
            counts[gap - length] += 1
        assert all(packer.count[g] == counts[g] == sum(n for _, n in packer.open[g]) for g in range(1, size))


def test_groups_fill_no_worse():
    rnd = random.Random(6)
    counts = {length: rnd.randint(1, 4000) for length in range(1, 4097, 7)}
    least = -(-sum(k * n for k, n in counts.items()) // 4096)
    places, made = P.pack_counts(counts, 4096, 3000)
    assert made <= least * 1.01 and places[:, 2].sum() == sum(counts.values())


def placed_singly(counts, size):
    packer = P.Packer(size)
    for length in sorted(counts, reverse=True):
        for rank in range(counts[length]):
            packer.add(length, rank, 1)
    return packer


@pytest.mark.parametrize("seed, most, size", [(1, 9, 40), (2, 60, 40), (3, 7000, 40), (4, 300, 97)])
def test_any_number_of_documents_is_placed_like_single_ones(seed, most, size):
    rnd = random.Random(seed)
    counts = {length: rnd.randint(1, most) for length in rnd.sample(range(1, size + 1), size // 2)}
    packer = P.Packer(size)
    for length in sorted(counts, reverse=True):
        packer.add(length, 0, counts[length])
    single = placed_singly(counts, size)
    assert packer.made == single.made and packer.count.tolist() == single.count.tolist()
    places, made = P.pack_counts(counts, size)
    assert made == single.made and P.pack_counts(counts, size, 3)[0].tolist() == places.tolist()
    spans = collections.defaultdict(list)  # each sequence gapless from 0, each rank once
    for length, rank, many, first, offset in places.tolist():
        for i in range(many):
            spans[first + i].append((offset, length))
    for parts in spans.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= size
    ranks = sorted((length, rank + i) for length, rank, many, _, _ in places.tolist() for i in range(many))
    assert ranks == [(length, i) for length in sorted(counts) for i in range(counts[length])]


def test_empty(spark):
    assert P.packed(spark.createDataFrame([], SCHEMA), PATH).count() == 0
