"""Language-model scores from a probabilistic suffix tree over the bytes of the words.

A text is the bytes of its lower-cased words with a space after each, and a line end. The tree's nodes are contexts of
up to ``DEPTH`` symbols (classes of bytes). Contexts of up to ``SHORT`` symbols stay. A longer one stays if it occurs
``LEAST`` times and its next-symbol distribution diverges from that of the context one symbol shorter, or if a longer
one needs it. Distributions are smoothed towards the shorter context's. A symbol's probability comes from the longest
context in the tree.

Next to it stands the word-frequency base: counts of all training words, looked up for every word of every text.
Texts are dealt to buckets by hash; a bucket sends its distinct words and its distinct grams (``DEPTH`` symbols and the
next one) with its own counts, packed by stretches of keys, and gets back the words' totals and the grams'
probabilities. Grams meet by the newest symbols of their contexts, so that all longer contexts of a branch are weighed
by one task and no task or driver holds the tree; stretches are cut by how often branches occur; only the counts after the short contexts, a table of fixed size, go to all.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, whole, written
from millrace.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 6
#: Contexts of so many symbols always stay: CLASSES ** SHORT of the longest.
SHORT = 2
#: How often a longer context must occur.
LEAST = 2
#: A context must gain this many nats a distinct next symbol, times the logarithm of its count, by being kept.
GAIN = 0.5
#: Text of a bucket, about: its distinct words and grams are held by one task.
BUCKET_BYTES = 32_000_000
#: Training text behind a slot's keys, about, and the bounds of the number of slots.
SLOT_BYTES, LEAST_SLOTS, MOST_SLOTS = 4_000_000, 256, 1 << 14
#: Weight of the shorter context in a longer one's distribution.
SMOOTH = 4.0
CLASS_BITS, CLASSES = 6, 64
SPACE, END = 26, 27


def byte_classes() -> np.ndarray:
    """Class of each byte: letters, space, line end, digits, some marks, UTF-8 continuation and lead bytes by kind."""
    out = np.full(256, 29, np.uint8)
    out[97:123] = np.arange(26)
    out[32], out[10] = SPACE, END
    out[48:58] = 28
    for i, c in enumerate(b".,'-!?\"|$*%&#"):
        out[c] = 30 + i
    out[0x80:0xC0] = 43 + (np.arange(64) >> 2)
    out[0xC0:] = 61
    out[0xC2], out[0xC3], out[0xE0:] = 59, 60, 62
    return out


CLASS = byte_classes()


def stream(text: str | None) -> bytes:
    """Line ends to look back on, the lower-cased words with a space after each, and the closing line end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return b"\n" * DEPTH + b" ".join([*words, b""]) + b"\n"


# Training


def _coded(texts: list[str | None], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each symbol that is predicted: the ``depth`` symbols before it, the newest highest, and itself, six bits each; its byte. And how many each text has."""
    streams = [stream(t) for t in texts]
    size = np.fromiter(map(len, streams), np.int64, len(streams))
    body = np.frombuffer(b"".join(streams), np.uint8)
    symbols = CLASS[body].astype(np.int64)
    code = np.zeros(max(0, len(body) - DEPTH), np.int64)
    for back in [*range(1, depth + 1), 0]:
        code <<= CLASS_BITS
        code |= symbols[DEPTH - back : len(body) - back]
    # all but the line ends in front
    target = np.ones(len(code), bool)
    starts = np.cumsum(size)[:-1]
    for j in range(DEPTH):
        target[starts + j - DEPTH] = False
    return code[target], body[DEPTH:][target], size - DEPTH


class Short:
    """Counts and smoothed distributions after the contexts of SHORT symbols, and how the bytes of a class share it."""

    def __init__(self, counts: np.ndarray, by_byte: np.ndarray):
        self.counts = counts.reshape(-1, CLASSES)
        self.totals = self.counts.sum(1)
        share = np.full(CLASSES, 1 / CLASSES)
        for length in range(SHORT + 1):
            follow = counts.reshape(CLASSES**length, -1, CLASSES).sum(1)
            # the context one symbol shorter lacks the oldest one, which stands lowest
            base = np.repeat(share.reshape(-1, CLASSES), CLASSES if length else 1, axis=0)
            share = (follow + SMOOTH * base) / (follow.sum(1, keepdims=True) + SMOOTH)
        self.share = share
        self.byte, self.texts, self.bytes = byte_logs(by_byte), int(by_byte[10]), int(by_byte.sum())


def byte_logs(by_byte: np.ndarray) -> np.ndarray:
    """log10 share of each byte in its class: a class's probability goes to its bytes by their counts."""
    within = by_byte + 0.5
    return np.log10(within / np.bincount(CLASS, weights=within, minlength=CLASSES)[CLASS])


def short_contexts(texts: DataFrame) -> Short:
    """Counted over texts. The driver gets at most CLASSES ** (SHORT + 1) + 256 rows."""
    size = CLASSES ** (SHORT + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 256, np.int64)
        for batch in in_batches(batches, 4, 0):
            code, byte, _ = _coded(batch.column(0).to_pylist(), SHORT)
            total[:size] += np.bincount(code, minlength=size)
            total[size:] += np.bincount(byte, minlength=256)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    counts = texts.select(F.col("text").cast("string")).mapInArrow(run, "code long, n long")
    found = counts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size + 256)
    total[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return Short(total[:size], total[size:])


def gram_logs(grams: np.ndarray, n: np.ndarray, counts: np.ndarray, totals: np.ndarray, short: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last symbol after the longest context in the tree.

    ``grams`` are in order and distinct, with every gram of each context of SHORT + 1 symbols among them; ``n`` says how
    often training texts have them. The others are counts, their totals and shares after the contexts of SHORT symbols.
    """
    symbols = grams & (CLASSES - 1)
    # counts and probabilities of each gram's symbol after the context of the length at hand; which gram has which pair
    start = grams >> CLASS_BITS * (DEPTH + 1 - SHORT)
    parent_n, parent_total, share = counts[start, symbols], totals[start], short[start, symbols]
    nodes, keep, shares = [], [], []
    for length in range(SHORT + 1, DEPTH + 1):
        context = grams >> CLASS_BITS * (DEPTH + 1 - length)
        first = np.append(True, context[1:] != context[:-1])
        node = np.cumsum(first) - 1
        total = np.bincount(node, weights=n)
        _, one, pair = np.unique(node << CLASS_BITS | symbols, return_index=True, return_inverse=True)
        count = np.bincount(pair, weights=n)
        seen = count > 0
        at, follow = node[one][seen], count[seen]
        gain = np.bincount(at, weights=follow * np.log(follow / total[at] * (parent_total / np.maximum(parent_n, 1))[one][seen]), minlength=len(total))
        sort = np.bincount(at, minlength=len(total))
        nodes.append(node)
        keep.append((total >= LEAST) & (gain >= GAIN * sort * np.log(np.maximum(total, 1))))
        parent_n, parent_total = count[pair], total[node]
        share = (parent_n + SMOOTH * share) / (parent_total + SMOOTH)
        shares.append(share)
    out = short[start, symbols]
    # with each context all its suffixes
    for i in range(len(nodes) - 1, 0, -1):
        keep[i - 1][nodes[i - 1][keep[i][nodes[i]]]] = True
    for node, stays, share in zip(nodes, keep, shares):
        out = np.where(stays[node], share, out)
    return np.log10(out).astype(np.float32)


# Words


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two halves of a 128-bit XXH3 code for each distinct lower-cased word, which of them each word is, and words a text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.large_string())))
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    codes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w.encode()) for w in distinct]), np.uint64).reshape(-1, 2)
    at = coded.indices.to_numpy().astype(np.int64)
    word = np.array([bool(w) for w in distinct], bool)[at]  # white space at an end leaves an empty one
    offsets = lists.offsets.to_numpy()
    edges = np.concatenate([[0], np.cumsum(word)])[offsets - offsets[0]]
    return codes[:, 0], codes[:, 1], at[word], np.diff(edges)


def _order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """By both halves of a code; the second one is looked at only where first halves meet."""
    order = np.argsort(high)
    same = high[order[1:]] == high[order[:-1]]
    if (low[order[1:]] != low[order[:-1]])[same].any():
        order = np.lexsort((low, high))
    return order


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their counts, which come last. A key is one number or two."""
    *keys, n = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(keys[0]) if len(keys) == 1 else _order(*keys)
    keys, n = [k[order] for k in keys], n[order]
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)) if len(n) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return *(k[first] for k in keys), np.add.reduceat(n, first) if len(first) else n


# Keys travel packed: one row for a bucket and a slot, a stretch of keys, with all of the bucket's keys there in order. What is
# alike in neighbouring numbers, the high bytes of steps and counts, lies together and costs next to nothing.


def planes(numbers: np.ndarray, steps: bool = False) -> bytes:
    """All first bytes, then all second ones, and so on; of the steps from number to number if they are in order."""
    if steps:
        numbers = np.diff(numbers, prepend=numbers.dtype.type(0))
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes()


def unplaned(body: bytes, kind: type, steps: bool = False) -> np.ndarray:
    rows = np.frombuffer(body, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    numbers = np.ascontiguousarray(rows.T).reshape(-1).view(kind)
    return np.cumsum(numbers, dtype=kind) if steps else numbers


PACKED = "gram boolean, slot int, bucket long, key binary, low binary, value binary"


def slot_edges(counts: np.ndarray, slots: int) -> np.ndarray:
    """First branch of each slot after the first, slots being alike in how often their branches occur in training texts.

    A branch is the SHORT + 1 newest symbols of a context, the newest highest; ``counts`` are those of ``Short``.
    """
    table = counts.reshape([CLASSES] * (SHORT + 1))  # newest to oldest context symbol, then the symbol after them
    weight = np.moveaxis(table, -1, 0).reshape(-1) + 1e-9
    reached = np.cumsum(weight)
    return np.searchsorted(reached, reached[-1] * np.arange(1, slots) / slots)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    types = [pa.bool_(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["gram", "slot", "bucket", "key", "low", "value"])


def bucket_keys(bucketed: DataFrame, word_slots: int, edges: np.ndarray) -> DataFrame:
    """The distinct words and grams of each bucket and how often training texts of the bucket have them, packed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, words, grams = None, [], []

        def rows(gram: bool, slot_of: np.ndarray, keys: np.ndarray, low: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.append(np.flatnonzero(np.append(True, slot_of[1:] != slot_of[:-1])), len(slot_of))
            ready = []
            for x, y in zip(cuts, cuts[1:]):
                ready.append((gram, int(slot_of[x]), int(bucket), planes(keys[x:y], True), low[x:y].tobytes(), planes(n[x:y])))
                if len(ready) == 64:
                    yield _packed(ready)
                    ready = []
            if ready:
                yield _packed(ready)

        def out() -> Iterator[pa.RecordBatch]:
            if words:
                high, low, n = _merged(words)
                if len(n):
                    yield from rows(False, (high >> np.uint64(32)) * np.uint64(word_slots) >> np.uint64(32), high, low, n)
            if grams:
                keys, n = _merged(grams)
                branch = keys >> CLASS_BITS * (DEPTH - SHORT)
                yield from rows(True, np.searchsorted(edges, branch, side="right"), keys, np.zeros(0, np.uint64), n)

        for batch in in_batches(batches, 4, 2):
            buckets = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])).tolist() + [len(buckets)]
            for x, y in zip(cuts, cuts[1:]):
                if buckets[x] != bucket:
                    yield from out()
                    bucket, words, grams = buckets[x], [], []
                texts, held = batch.column(2).slice(x, y - x), batch.column(1).slice(x, y - x)
                for teaches, part in ((1, texts.filter(pc.invert(held))), (0, texts.filter(held))):
                    if not len(part):
                        continue
                    high, low, at, _ = words_of(part)
                    n = np.bincount(at, minlength=len(high))
                    there = n > 0
                    words.append((high[there], low[there], teaches * n[there]))
                    keys = _coded(part.to_pylist(), DEPTH)[0]
                    keys.sort()
                    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
                    grams.append((keys[first], teaches * np.diff(np.append(first, len(keys)))))
                for parts in (words, grams):
                    if sum(len(p[0]) for p in parts[1:]) > 2_500_000:
                        parts[:] = [_merged(parts)]
        yield from out()

    return bucketed.select("bucket", "held_out", "text").mapInArrow(run, PACKED)


def shared_counts(keys: DataFrame, short: Broadcast) -> DataFrame:
    """The packed rows with other values: a word's count over all buckets, or a gram's log10 probability.

    ``keys`` are sorted by slot, words and grams in partitions of their own, and all grams of a context of SHORT + 1 symbols
    in one slot; a task holds one slot at a time. One row a task with bucket -1 has in its slot's place the number
    of distinct words that training texts hold, and as value that of all their words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, every = 0, 0

        def closed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal distinct, every
            gram = rows[0][0]
            kind = np.int64 if gram else np.uint64
            key = np.concatenate([unplaned(r[3], kind, True) for r in rows])
            n = np.concatenate([unplaned(r[5], np.int64) for r in rows])
            if gram:
                order = np.argsort(key)
                new = np.append(True, key[order[1:]] != key[order[:-1]])
            else:
                low = np.concatenate([np.frombuffer(r[4], kind) for r in rows])
                order = _order(key, low)
                new = np.append(True, (key[order[1:]] != key[order[:-1]]) | (low[order[1:]] != low[order[:-1]]))
            first = np.flatnonzero(new)
            totals, times = np.add.reduceat(n[order], first), np.diff(np.append(first, len(key)))
            found = gram_logs(key[order][first], totals, *short.value[:3]) if gram else totals
            if not gram:
                distinct, every = distinct + int((totals > 0).sum()), every + int(totals.sum())
            value = np.empty(len(key), found.dtype)
            value[order] = np.repeat(found, times)
            at = np.concatenate([[0], np.cumsum([len(r[3]) // 8 for r in rows])])
            for x in range(0, len(rows), 64):
                yield _packed([(*r[:5], planes(value[a:b])) for r, a, b in zip(rows[x : x + 64], at[x:], at[x + 1 :])])

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[1] != held[0][1]:
                    yield from closed(held)
                    held = []
                held.append(row)
        if held:
            yield from closed(held)
        yield _packed([(False, 0, -1, int(distinct).to_bytes(8, "little"), b"", every.to_bytes(8, "little"))])

    return keys.select("gram", "slot", "bucket", "key", "low", "value").mapInArrow(run, PACKED)


def _found(high: np.ndarray, low: np.ndarray, table: tuple[np.ndarray, ...]) -> np.ndarray:
    """Counts of words from the sorted table, which has them all."""
    at = np.searchsorted(table[0], high)
    wrong = np.flatnonzero(table[1][at] != low)
    while len(wrong):  # words that share the first half of their codes stand next to each other
        at[wrong] += 1
        wrong = wrong[table[1][at[wrong]] != low[wrong]]
    return table[2][at]


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from rows that are not held out; a null text is empty: one end token. Words are told apart by 128-bit codes.
    Without training rows nothing is known and the tree is uniform; equal rows count, and are scored, as often as given.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), whole(F.col("text").cast("string")).alias("text"))
    taught_rows = rows.filter(~F.col("held_out"))
    found = short_contexts(taught_rows)
    taught, n = found.texts, parallelism(docs.sparkSession)
    short = docs.sparkSession.sparkContext.broadcast((found.counts, found.totals, found.share, found.byte))
    buckets = max(n, -(-found.bytes // BUCKET_BYTES))
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, found.bytes // SLOT_BYTES))
    word_slots, edges = slots // 4, slot_edges(found.counts, slots)
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))
    keys = bucket_keys(bucketed.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket"), word_slots, edges)
    # words to the first n partitions, grams to the others
    part = F.pmod("slot", F.lit(n)) + F.when(F.col("gram"), n).otherwise(0)
    met = keys.withColumn("part", part.cast("int")).repartitionById(2 * n, "part").sortWithinPartitions("slot")
    shared = written(shared_counts(met, short), "suffix-tree-shared")
    ends = shared.filter("bucket < 0").select("key", "value").collect()  # two numbers a task
    known_words, all_words = (sum(int.from_bytes(r[i], "little") for r in ends) for i in (0, 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, table = None, ([], []), None
        for batch in in_batches(batches, 4, 6):
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])).tolist() + [len(numbers)]
            for x, y in zip(cuts, cuts[1:]):
                if numbers[x] != bucket:
                    bucket, parts, table = numbers[x], ([], []), None
                piece = batch.slice(x, y - x)
                sent = piece.filter(pc.is_valid(piece.column(1)))  # they come first, words before grams, in order of slots
                for gram, key, low, value in zip(*(sent.column(i).to_pylist() for i in range(1, 5))):
                    if gram:
                        parts[1].append((unplaned(key, np.int64, True), unplaned(value, np.float32)))
                    else:
                        parts[0].append((unplaned(key, np.uint64, True), np.frombuffer(low, np.uint64), unplaned(value, np.int64)))
                texts = piece.filter(pc.is_null(piece.column(1)))
                if not texts.num_rows:
                    continue
                if table is None:
                    none = np.zeros(0, np.uint64)
                    table = [np.concatenate(p) for p in zip(*parts[0], (none, none, none.astype(np.int64)))]
                    grams, logs_of = (np.concatenate(p) for p in zip(*parts[1]))
                    place = pd.Index(grams)  # a hash table
                    parts = [], []
                high, low, at, sizes = words_of(texts.column(6))
                total = np.zeros(len(high), np.int64)
                there = np.flatnonzero(np.bincount(at, minlength=len(high)))
                total[there] = _found(high[there], low[there], table)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                coded, byte, counts = _coded(texts.column(6).to_pylist(), DEPTH)
                score = np.add.reduceat(logs_of[place.get_indexer(coded)] + short.value[3][byte], np.cumsum(counts) - counts)
                columns = [
                    texts.column(5), texts.column(7), pa.array(sizes + 1),
                    pa.array(np.bincount(doc, weights=(total > 0)[at], minlength=len(sizes)).astype(np.int64)),
                    pa.array(np.bincount(doc, weights=np.log10(total + 0.1)[at], minlength=len(sizes))),
                    pa.array(score),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "known_words", "log_counts", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, known_words long, log_counts double, score double"
    packed = ["gram", "key", "low", "value"]
    own = {"doc_id": "long", "text": "string", "held_out": "boolean"}
    back = shared.filter("bucket >= 0").select("bucket", *packed, *[F.lit(None).cast(t).alias(c) for c, t in own.items()], "slot")
    kinds = dict(shared.dtypes)
    texts = bucketed.select("bucket", *[F.lit(None).cast(kinds[c]).alias(c) for c in packed], *own, F.lit(None).cast("int").alias("slot"))
    both = back.union(texts).repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", F.isnull("slot"), "gram", "slot")
    scored = both.drop("slot").mapInArrow(run, schema)
    distinct, total = known_words + (1 if taught else 0), all_words + taught
    # an end token closes every text; it is known once a training text has closed
    norm = F.log10(F.lit(total + 0.1 * (distinct + 1)))
    base = F.col("log_counts") + F.log10(F.lit(taught + 0.1)) - F.col("n_tokens") * norm
    known = F.col("known_words") + F.lit(1 if taught else 0)
    return scored.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
