import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from millrace.llm import bpe as B

tiktoken = pytest.importorskip("tiktoken")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(RANKS)


@pytest.fixture(scope="module")
def exact(ranks):
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts(n=300, seed=1):
    rnd = random.Random(seed)
    kinds = ["abcdefghij", "the and ing er on re ", " \n\t", "éñüß", "日本語🙂", "0123456789", "'!?.,-$#", "thandinger", "‍́"]
    out = ["", " ", "a" * 3000, "ab" * 2000, " " * 999, "don't we'll", "\x00\x01", "".join(map(chr, range(1, 2500))), "x" * 30_000]
    for _ in range(n):
        out.append("".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.choice([1, 5, 60, 400]))))
    return out


@pytest.mark.parametrize("states, pieces", [(200_000, 150_000), (50, 20)])
def test_encodes_as_the_library_does(ranks, exact, monkeypatch, states, pieces):
    monkeypatch.setattr(B, "MAX_STATES", states)
    monkeypatch.setattr(B, "MAX_PIECES", pieces)
    encoder, decoder, every = B.Encoder(ranks, P.PATTERN), B.Decoder(ranks), texts()
    for x in range(0, len(every), 70):
        part = every[x : x + 70]
        ids, at = encoder.encode(part)
        for t, a, b in zip(part, at, at[1:]):
            assert ids[a:b].tolist() == exact(t), t[:60]
            assert decoder.decode(ids[a:b]) == t.encode()


def test_random_ranks_equal_plain_merging():
    """Vocabularies of a few letters, where almost every pair of tokens matters."""
    for seed in range(6):
        rnd = random.Random(seed)
        ranks = {bytes([b]): b for b in range(256)}
        tokens = [b"a", b"b", b"c"]
        while len(tokens) < 60:
            new = rnd.choice(tokens) + rnd.choice(tokens)
            if len(new) <= 9 and new not in ranks and len(B.Transducer(ranks).merge(new)) == 2:
                ranks[new] = len(ranks)
                tokens.append(new)
        machine = B.Transducer(ranks)
        for _ in range(300):
            piece = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 40)))
            assert machine.encode(piece) == [ranks[t] for t in machine.merge(piece)], (seed, piece)


def test_utf8_stream_cuts_anywhere():
    text = "aé日🙂́ z" * 5
    body = text.encode()
    for step in (1, 2, 3, 5, len(body)):
        stream, out = B.Utf8Stream(), ""
        for x in range(0, len(body), step):
            out += stream.feed(body[x : x + step])
        assert out + stream.end() == text
    broken = B.Utf8Stream()
    assert broken.feed(b"ok\xff\xc3") + broken.end() == "ok��"


def test_documents(spark, exact):
    rows = [(1, "Hello world", 1), (2, None, 2), (3, "", 3), (1, "Hello world", 1), (None, "é🙂" * 2000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    want = []
    for i, t, _ in rows:
        ids = exact(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = B.encode_digest(docs, RANKS, P.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = B.decode_ids(B.encode_documents(docs, RANKS, P.PATTERN), RANKS, chunk=3).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=str) == sorted(((i, t or "") for i, t, _ in rows), key=str)
    assert B.encode_digest(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_digest_is_the_same_however_short_the_chunks(spark):
    rows = [(1, "añ漢🙂 " * 50), (2, "🙂"), (3, None), (None, "é"), (2, "🙂")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    for chunk in (1, 3, 4096):
        out = B.encode_digest(docs, RANKS, P.PATTERN, chunk).collect()
        assert sorted((str(r["doc_id"]), r["decoded_sha256"]) for r in out) == want


def test_encoded_rows_are_decoded_and_checked(spark, monkeypatch):
    """Null and empty texts give no ids, repeated and null doc_ids stay, clashing columns leave; wrong ids stop the job."""
    made = [(1, "café \U0001f600 " * 9, 5), (1, "café", 6), (None, "", 7), (3, None, 8)]
    docs = spark.createDataFrame(made, "doc_id long, text string, decoded_sha256 int")
    got = B.encode_documents(docs, RANKS, P.PATTERN, decode=True, chunk=2).collect()
    want = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in made]
    assert sorted(((r["doc_id"], r["decoded_sha256"]) for r in got), key=str) == sorted(want, key=str)
    assert [len(r["ids"]) for r in got if r["doc_id"] in (None, 3)] == [0, 0]

    class Forgetful(B.Decoder):
        def decode(self, ids):
            return super().decode(ids)[:-1]

    monkeypatch.setattr(B, "_decoder", lambda path: Forgetful(B.read_ranks(path)))
    with pytest.raises(Exception, match="ids do not decode to the text of doc_id"):
        B.encode_documents(docs, RANKS, P.PATTERN, decode=True).collect()
