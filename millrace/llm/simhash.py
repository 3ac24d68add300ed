"""SimHash near-duplicates: fingerprints, links at a small bit distance, groups.

Links are found by the general pigeonhole rule: split the 64 bits into m parts with thresholds t_i that sum to
``distance - m + 1``; two fingerprints within ``distance`` bits then differ in at most t_i bits of some part i
(a part with t_i = -1 is never probed). Bits that vary together share a part, and thresholds are chosen by
dynamic programming on candidate counts taken from all fingerprints.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, written
from millrace.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
#: A bucket with more entries is split by further bits before its entries are compared.
HOT = 2048
#: Cost of moving one probe, in comparisons of a candidate pair.
MOVE = 8.0


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash over XXH64 (seed 42) of the word shingles, as a signed long; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], "<u8")
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(size + 1) - size - 1
        stops = (starts + size)[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), stops)), "<u8", len(stops))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: str = "doc_id") -> DataFrame:
    """The column ``carry`` and fp of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], [carry, "fp"])

    rows = docs.select(carry, F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(run, rows.select(carry).withColumn("fp", F.lit(0).cast("long")).schema)


# Choosing parts and thresholds


def bit_sums(distinct: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, over all fingerprints: 64 x 64 sums, one row of 64 for each task and bit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            for at in range(0, len(fps), 65536):
                x = np.unpackbits(fps[at : at + 65536], axis=1, bitorder="little").astype(np.float64)
                total[:BITS] += x.T @ x
                total[BITS] += len(x)
        if total[BITS, 0]:
            rows = [pa.array(np.arange(BITS + 1), pa.int32())] + [pa.array(total[:, j]) for j in range(BITS)]
            yield pa.RecordBatch.from_arrays(rows, ["i", *[f"c{j}" for j in range(BITS)]])

    names = [f"c{j}" for j in range(BITS)]
    schema = "i int, " + ", ".join(f"{n} double" for n in names)
    got = distinct.select("fp").mapInArrow(run, schema).groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect()
    out = np.zeros((BITS + 1, BITS))
    for r in got:
        out[r["i"]] = [r[n] for n in names]
    return out


def correlated_parts(sums: np.ndarray, m: int) -> list[list[int]]:
    """m parts of near equal width; each starts from the bit that correlates most and takes the bits nearest to it."""
    n = max(sums[BITS, 0], 1.0)
    p = np.diag(sums[:BITS]) / n
    var = np.maximum(p * (1 - p), 1e-12)
    r = np.abs(sums[:BITS] / n - np.outer(p, p)) / np.sqrt(np.outer(var, var))
    np.fill_diagonal(r, 0)
    left, parts = list(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        part = [max(left, key=lambda b: (r[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (r[b, part].sum(), -b)))
            left.remove(part[-1])
        parts.append(sorted(part))
    return parts


def ball(width: int, radius: int) -> int:
    """Values within so many bits of a value."""
    total, term = 0, 1
    for d in range(radius + 1):
        total += term
        term = term * (width - d) // (d + 1)
    return total


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one a part, that sum to ``total`` at the least cost: dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in options.items():
                key, new = done + t, cost + more
                if key not in following or new < following[key][0]:
                    following[key] = (new, [*chosen, t])
        best = following
    return best.get(total, (float("inf"), []))


def plan_parts(distinct: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, from the sums and value counts of all fingerprints.

    Equal pairs of a part are counted exactly. Pairs one or two bits apart are estimated from them by each bit's
    odds of differing. Costs weigh candidate pairs against probes to be moved.
    """
    sums = bit_sums(distinct)
    n = max(sums[BITS, 0], 1.0)
    p = np.diag(sums[:BITS]) / n
    odds = 2 * p * (1 - p) / np.maximum(p * p + (1 - p) ** 2, 1e-12)
    trials = {m: correlated_parts(sums, m) for m in range(1, distance + 3)}
    flat = [(m, k, part) for m, parts in trials.items() for k, part in enumerate(parts)]
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(_mask(part)).alias("v")) for i, (_, _, part) in enumerate(flat)])
    values = distinct.select(F.explode(keys).alias("k")).groupBy("k.i", "k.v").agg(F.count("*").alias("n"))
    pairs = {r["i"]: float(r["p"]) for r in values.groupBy("i").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("p")).collect()}
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m, parts in trials.items():
        costs = []
        for k, part in enumerate(parts):
            equal = pairs.get(flat.index((m, k, part)), 0.0)
            e1 = odds[part].sum()
            e2 = (e1**2 - (odds[part] ** 2).sum()) / 2
            near = [equal, equal * (1 + e1), equal * (1 + e1 + e2)]
            options = {-1: 0.0}
            for t in range(min(distance, 2, len(part)) + 1):
                options[t] = near[t] + MOVE * n * ball(len(part), t)
            costs.append(options)
        cost, chosen = allocate(costs, distance - m + 1)
        if cost < best[0]:
            best = (cost, [(part, t) for part, t in zip(parts, chosen) if t >= 0])
    return best[1]


def _mask(bits: Iterable[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


# Probing


def _probes(parts: list[tuple[list[int], int]]):
    """Every fingerprint's bucket keys: its own value of each part, and the values within the threshold."""
    out = []
    for i, (bits, t) in enumerate(parts):
        free = F.lit(_mask(b for b in range(BITS) if b not in bits))
        for d in range(t + 1):
            for flipped in combinations(bits, d):
                value = F.col("fp").bitwiseAND(_mask(bits)).bitwiseXOR(_mask(flipped)) if flipped else F.col("fp").bitwiseAND(_mask(bits))
                out.append(F.struct(F.xxhash64(F.lit(i), value).alias("key"), F.lit(d == 0).alias("own"), free.alias("free")))
    return F.explode(F.array(*out))


#: Times that crowded buckets are split; what is crowded still is compared as it is.
ROUNDS = 6


def _shares(round_: int, n: int) -> list[int]:
    """The 64 bits dealt into n masks, otherwise in each round."""
    order = np.random.default_rng(round_).permutation(BITS)
    return [_mask(int(b) for b in order[j::n]) for j in range(n)]


def linked(values: np.ndarray, own: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Star edges that join the same fingerprints as all links among the entries of a bucket."""
    n = len(values)
    near = np.zeros((n, n), bool)
    step = max(1, 4_000_000 // n)
    for at in range(0, n, step):
        near[at : at + step] = np.bitwise_count(values[at : at + step, None] ^ values[None, :]) <= distance
    near &= own[:, None] | own[None, :]
    if near.sum() == n:
        return []
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(1)
        least = np.minimum(least, label)[np.minimum(least, label)]
        if (least == label).all():
            break
        label = least
    return [(int(values[i]), int(values[r])) for i, r in enumerate(label) if values[i] != values[r]]


def links(distinct: DataFrame, distance: int = 2, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints connected by pairs at ``distance`` bits or fewer.

    Buckets of more than ``hot`` entries are split by the bits that may still differ: entries within ``distance`` agree
    on one of ``distance + 1`` shares of those, so each entry goes to that many smaller buckets. No pair is dropped.
    """
    parts = plan_parts(distinct, distance)
    level = distinct.select("fp", _probes(parts).alias("k")).select("fp", "k.*")
    done = []
    for round_ in range(ROUNDS + 1):
        sizes = level.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("any")).filter((F.col("n") > 1) & F.col("any"))
        last = round_ == ROUNDS or not sizes.filter(F.col("n") > hot).limit(1).count()
        small = sizes if last else sizes.filter(F.col("n") <= hot)
        done.append(level.join(small.select("key"), "key").groupBy("key").agg(F.collect_list(F.struct("fp", "own")).alias("e")).select("e"))
        if last:
            break
        crowded = level.join(sizes.filter(F.col("n") > hot).select("key"), "key")
        splits = []
        for j, share in enumerate(_shares(round_, distance + 1)):
            key = F.xxhash64("key", F.lit(j), F.col("fp").bitwiseAND(F.col("free")).bitwiseAND(share))
            splits.append(F.struct(key.alias("key"), F.col("own").alias("own"), F.col("free").bitwiseAND(~share).alias("free")))
        level = written(crowded.select("fp", F.explode(F.array(*splits)).alias("k")).select("fp", "k.*"), "simhash-crowded")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            at = lists.offsets.to_numpy()
            entries = lists.values
            fps, own = entries.field(0).to_numpy(zero_copy_only=False).view(np.uint64), entries.field(1).to_numpy(zero_copy_only=False)
            out = []
            for x, y in zip(at[:-1], at[1:]):
                values, first = np.unique(fps[x:y], return_inverse=True)
                if len(values) > 1:
                    mine = np.zeros(len(values), bool)
                    np.logical_or.at(mine, first, own[x:y])
                    out += linked(values, mine, distance)
            a = np.array([e[0] for e in out], np.uint64).view(np.int64)
            b = np.array([e[1] for e in out], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    return found.mapInArrow(run, "a long, b long")


def groups(fps: DataFrame, distance: int = 2, hot: int = HOT) -> DataFrame:
    """fp, root (the smallest fingerprint of its group) and component_id, the smallest doc_id of the group.

    Rows without doc_id link like others but never name a group; a group of such rows only has a null id.
    """
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct, distance, hot))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    named = written(named.select("fp", "least", "root"), "simhash-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(ids, "root").select("fp", "root", "component_id")


def with_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    Null and empty texts have fingerprint zero and link like any other; equal rows share a group.
    """
    fps = written(fingerprints(with_id(docs), shingle), "simhash-prints")
    found = groups(fps, distance, hot)
    return fps.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest doc_id stays.

    Of several rows with that doc_id the one first in JSON order stays. A row without doc_id stays only if its whole
    group has none.
    """
    fps = written(fingerprints(with_id(docs), shingle), "simhash-prints")
    found = written(groups(fps, distance), "simhash-groups")
    mine, times, whole_row = fresh(docs, "_winner", "_times", "_row")
    named = fps.join(found, "fp").filter(F.col("doc_id") == F.col("component_id"))
    winners = written(named.groupBy(F.col("doc_id").alias(mine)).agg(F.count("*").alias(times)), "simhash-winners")
    key = docs["doc_id"].cast("long")
    # the winners grow with the documents: never sent to all tasks, at any size
    kept = docs.join(winners.filter(F.col(times) == 1).hint("merge"), key == F.col(mine), "left_semi")
    # rows that share their doc_id or have none: rarely any
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole_row)
    first = F.min_by(whole_row, F.to_json(F.struct(whole_row))).alias(whole_row)
    if winners.filter(F.col(times) > 1).limit(1).count():
        several = docs.join(winners.filter(F.col(times) > 1), key == F.col(mine), "left_semi")
        kept = kept.union(several.select(F.col("doc_id").alias(mine), row).groupBy(mine).agg(first).select(f"{whole_row}.*"))
    if fps.filter(F.col("doc_id").isNull()).limit(1).count():
        nameless = fingerprints(docs.filter(F.col("doc_id").isNull()).select(row, "text"), shingle, whole_row)
        alone = nameless.join(found.filter(F.col("component_id").isNull()), "fp")
        kept = kept.union(alone.groupBy("root").agg(first).select(f"{whole_row}.*"))
    return kept
