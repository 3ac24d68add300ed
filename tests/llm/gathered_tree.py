"""The whole suffix tree of a small corpus in one place, grown by joins, to compare scores with."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, written
from millrace.llm.suffix_tree import CLASS, CLASS_BITS, CLASSES, DEPTH, GAIN, LEAST, SHORT, SMOOTH, _merged, byte_logs, stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY_BITS = CLASS_BITS * DEPTH  # a context's key is its length, then its symbols


class Tree:
    """Contexts as a trie that is read backwards, with a distribution at each node: the whole tree of a small corpus."""

    def __init__(self, keys: np.ndarray, symbols: np.ndarray, counts: np.ndarray, by_byte: np.ndarray):
        """Counts of the symbols after each context. ``keys`` are lengths and symbols of contexts, with every suffix of each among them."""
        contexts, at = np.unique(np.append(keys, 0), return_inverse=True)
        n = len(contexts)  # shorter ones first, the empty context at 0
        follow = np.zeros((n, CLASSES))
        np.add.at(follow, (at[:-1], symbols), counts)
        self.child = np.zeros((n, CLASSES), np.int32)  # 0: none, as the root is nobody's child
        share = np.empty((n, CLASSES))
        length, code = contexts >> KEY_BITS, contexts & ((1 << KEY_BITS) - 1)
        for k in range(int(length.max(initial=0)) + 1):
            own = np.flatnonzero(length == k)
            base = 1 / CLASSES
            if k:
                oldest = CLASS_BITS * (k - 1)
                parent = np.searchsorted(contexts, (k - 1) << KEY_BITS | code[own] & ((1 << oldest) - 1))
                self.child[parent, code[own] >> oldest] = own
                base = share[parent]
            share[own] = (follow[own] + SMOOTH * base) / (follow[own].sum(1, keepdims=True) + SMOOTH)
        self.log = np.log10(share).astype(np.float32)
        self.byte = byte_logs(by_byte)

    def positions(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Node of the longest context before each position, ``symbols`` being of 64 bits."""
        flat = self.child.reshape(-1)
        node = flat[symbols[at - 1]]
        live = np.flatnonzero(node)
        inner, spot = node[live], at[live]
        for back in range(2, DEPTH + 1):
            following = flat[(inner.astype(np.int64) << CLASS_BITS) + symbols[spot - back]]
            more = np.flatnonzero(following)
            if not len(more):
                break
            live, inner, spot = live[more], following[more], spot[more]
            node[live] = inner
        return node

    def score(self, texts: list[str | None]) -> np.ndarray:
        """log10 probability of each text."""
        streams = [stream(t) for t in texts]
        size = np.fromiter(map(len, streams), np.int64, len(streams))
        body = np.frombuffer(b"".join(streams), np.uint8)
        symbols = CLASS[body].astype(np.int64)
        at = np.arange(len(body))
        starts = np.cumsum(size) - size
        target = np.ones(len(body), bool)
        for j in range(DEPTH):
            target[starts + j] = False
        at = at[target]
        out = np.empty(len(at))
        log = self.log.reshape(-1)
        for x in range(0, len(at), 100_000):
            part = at[x : x + 100_000]
            node = self.positions(symbols, part).astype(np.int64)
            out[x : x + 100_000] = log[(node << CLASS_BITS) + symbols[part]] + self.byte[body[part]]
        counts = size - DEPTH
        return np.add.reduceat(out, np.cumsum(counts) - counts) if len(counts) else out


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over texts: DEPTH symbols and the one that follows, six bits each, the last one lowest.

    Also (-1 - byte, n): how often each byte occurs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        held, by_byte = 0, np.zeros(256, np.int64)

        for batch in in_batches(batches, 4, 0):
            body = np.frombuffer(b"".join([stream(t) for t in batch.column(0).to_pylist()]), np.uint8)
            by_byte += np.bincount(body, minlength=256)
            by_byte[10] -= DEPTH * batch.num_rows
            symbols = CLASS[body].astype(np.int64)
            gram = symbols[: len(symbols) - DEPTH].copy()
            for j in range(1, DEPTH + 1):
                gram <<= CLASS_BITS
                gram |= symbols[j : j + len(gram)]
            # positions that predict a symbol: all but the line ends in front
            target = np.ones(len(body), bool)
            ends = np.flatnonzero(body == 10)
            target[ends] = False
            # of each text's line ends only the closing one counts: the last of a run, not the run in front
            closing = ends[DEPTH :: DEPTH + 1]
            target[closing] = True
            gram = gram[target[DEPTH:]]
            part = gram
            part.sort()
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
            seen.append((part[first], np.diff(np.append(first, len(part)))))
            held += len(first)
            if held > 2_500_000:
                seen = [_merged(seen)]
                held = len(seen[0][0])
        if seen:
            grams, n = _merged(seen)
            bytes_at = np.flatnonzero(by_byte)
            columns = [pa.array(np.append(grams, -1 - bytes_at)), pa.array(np.append(n, by_byte[bytes_at]))]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n"])

    counts = texts.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def grow_tree(texts: DataFrame) -> Tree:
    """The tree of the texts, gathered on the driver: to look at the contexts of a small corpus. ``score_texts`` never gathers them."""
    grams = written(gram_counts(texts), "suffix-tree-grams")
    by_byte = np.zeros(256)
    for r in grams.filter("gram < 0").collect():
        by_byte[-1 - r["gram"]] = r["n"]
    level = grams.filter("gram >= 0")
    low = (1 << CLASS_BITS) - 1
    tables = []
    for length in range(DEPTH, -1, -1):
        mask = (1 << CLASS_BITS * (length + 1)) - 1
        level = level.groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("n").alias("n"))
        rows = level.select(F.shiftright("gram", CLASS_BITS).alias("context"), F.col("gram").bitwiseAND(low).cast("int").alias("symbol"), "n")
        follow = rows.groupBy("context").agg(F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("next"))
        tables.append(follow.filter((F.col("total") >= LEAST) | F.lit(length <= SHORT)).withColumn("length", F.lit(length)))
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    every = written(every, "suffix-tree-contexts")
    parents = every.select(F.col("length").alias("p_length"), F.col("context").alias("p_context"), F.col("total").alias("p_total"), F.map_from_entries("next").alias("p_next"))
    suffix = F.col("context").bitwiseAND(F.expr(f"shiftleft(1L, cast((length - 1) * {CLASS_BITS} AS INT)) - 1L"))
    child = every.filter("length > 0").withColumn("p_length", F.col("length") - 1).withColumn("p_context", suffix)

    def divergence(total: Column, follow: Column) -> Column:
        def add(done: Column, s: Column) -> Column:
            share = s["n"] / total
            shorter = F.element_at(F.col("p_next"), s["symbol"]) / F.col("p_total")
            return done + s["n"] * F.log(share / shorter)

        return F.aggregate(follow, F.lit(0.0), add)

    gain = divergence(F.col("total"), F.col("next"))
    kept = child.join(parents, ["p_length", "p_context"]).filter(gain >= GAIN * F.size("next") * F.log("total")).select("length", "context")
    # with each context all its suffixes, and the short ones
    own = F.expr(f"transform(sequence(0, length), l -> struct(l AS length, context & (shiftleft(1L, cast(l * {CLASS_BITS} AS INT)) - 1L) AS context))")
    wanted = kept.select(F.inline(own)).union(every.filter(F.col("length") <= SHORT).select("length", "context")).distinct()
    key = F.shiftleft(F.col("length").cast("long"), KEY_BITS).bitwiseOR(F.col("context"))
    counts = every.join(wanted, ["length", "context"]).select(key.alias("key"), F.explode("next").alias("s")).select("key", "s.symbol", "s.n").toArrow()
    keys, symbols, n = (counts.column(c).to_numpy() for c in ("key", "symbol", "n"))
    return Tree(keys, symbols, n, by_byte)
