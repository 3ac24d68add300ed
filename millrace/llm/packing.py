"""Packing documents into token sequences: each where the sum of squared counts of open sequences per gap becomes least.

Sequences with the same gap are alike, and so are documents of the same length. The packer therefore never sees a
document: it takes the counts of lengths, longest first, and finds how many of a length go into sequences of each gap when
each is placed by itself, however many there are. A new sequence is opened only where no open one has room. What it gives
back says which ranks of a length go to which sequences. Ranks come
from counts of (task, length), so documents are looked up where they lie.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, kept_in_process, ragged, whole, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Default of ``steps``, which callers may still give. It changes nothing: each document is placed by itself.
STEPS = 1 << 16
#: A worker's table of chunks starts anew beyond so many chunks or ids.
CHUNKS, CHUNK_IDS = 800_000, 16_000_000


# Encoding

#: After lower-casing, what a chunk may hold for the short way, and how it falls apart. Fixed values of the tokenizer's file.
PLAIN = re.compile("[!-~¡«»¿À-įı-ſ–—‘-”…]+")
LETTERS = "a-zß-öø-ſ"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts, chunk by chunk between ASCII white space, each distinct chunk once.

    The tokenizer drops white space and no piece crosses it, so a text's ids are those of its chunks one after another. A
    chunk of common letters and marks is lower-cased and split here and its pieces go to the tokenizer's model; any
    other goes through the whole tokenizer. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.piece: dict[str, tuple] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length, self.n_codes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _ids(self, piece: str) -> tuple:
        """The model's ids of one lower-case piece."""
        ids = self.piece.get(piece)
        if ids is None:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = tuple([t.id for t in self.model.tokenize(letters)])
            if len(piece) <= 64:
                self.piece[piece] = ids
        return ids

    def _plain(self, chunk: str) -> tuple | None:
        if chunk.isascii() and chunk.isalpha():
            return self._ids(chunk.lower())
        if not PLAIN.fullmatch(chunk):
            return None
        pieces = PIECES.findall(chunk.lower())
        out = self._ids(pieces[0])
        for piece in pieces[1:]:
            out += self._ids(piece)
        return out

    def _add(self, new: list) -> int:
        """Room for more chunks; the code of the first."""
        flat = np.fromiter(chain.from_iterable(new), np.uint32)
        lengths = np.array([len(ids) for ids in new], np.int64)
        first, n = self.n_codes, len(new)
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + n > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.start[first : first + n] = self.n_ids + np.cumsum(lengths) - lengths
        self.length[first : first + n] = lengths
        self.n_ids, self.n_codes = self.n_ids + len(flat), first + n
        return first

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and the number of ids of each."""
        if len(self.code) > CHUNKS or self.n_ids > CHUNK_IDS or len(self.piece) > CHUNKS:
            self.forget()
        lists = pc.ascii_split_whitespace(texts)
        chunks = lists.flatten().dictionary_encode()
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = list(map(self.code.get, distinct))
        missing = [c for c, code in zip(distinct, codes) if code is None]
        if missing:
            found = [self._plain(c) if c else () for c in missing]  # white space at an end leaves an empty chunk
            odd = [i for i, ids in enumerate(found) if ids is None]
            for i, e in zip(odd, self.tokenizer.encode_batch([missing[i] for i in odd], add_special_tokens=False)):
                found[i] = e.ids
            first = self._add(found)
            self.code.update(zip(missing, range(first, first + len(missing))))
            codes = [self.code[c] if code is None else code for c, code in zip(distinct, codes)]
        at = np.array(codes, np.int64)[chunks.indices.to_numpy()]
        lengths = self.length[at]
        ids = self.ids[ragged(self.start[at], lengths)]
        edges = np.concatenate([[0], np.cumsum(lengths)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return ids, np.diff(edges)


def token_pieces(docs: DataFrame, path: str, size: int, end: int, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, local) of every text, ``ids`` too if wanted.

    A text's ids and the id ``end`` are cut into pieces of ``size`` ids, the last one shorter. ``local`` numbers the pieces
    of one length within the task ``part``.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.disable()  # it would walk the tables again and again; nothing here is cyclic
        try:
            yield from cut(batches)
        finally:
            gc.enable()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_process(("packing", path), lambda: Encoder(path))
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in in_batches(batches, 4, 1):
            ids, n = encoder.encode(batch.column(1).cast(pa.large_string()))
            n = n + 1
            stop = np.cumsum(n)
            full = np.full(int(stop[-1]), end, np.uint32)
            inner = np.ones(len(full), bool)
            inner[stop - 1] = False
            full[inner] = ids
            pieces = -(-n // size)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = ragged(np.zeros(len(n)), pieces)
            start = piece * size
            length = np.minimum(size, n[doc] - start)
            begin = (stop - n)[doc] + start
            crc = [zlib.crc32(full[a : a + b]) for a, b in zip(begin, length)]
            order = np.argsort(length, kind="stable")
            sorted_lengths = length[order]
            local = np.empty(len(length), np.int64)
            local[order] = seen[sorted_lengths] + np.arange(len(length)) - np.searchsorted(sorted_lengths, sorted_lengths)
            seen += np.bincount(length, minlength=size + 1)
            columns = [
                batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(np.full(len(doc), part, np.int32)), pa.array(local),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(full.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text")).mapInArrow(run, schema)


# Packing


class Packer:
    """Sequences of ``size`` by gap, filled from counts of equal lengths.

    ``places`` gets (length, first rank, count, first sequence, offset): documents of a length with ranks from the
    first one on go to sequences from the first one on, at the offset.
    """

    def __init__(self, size: int):
        self.size, self.made = size, 0
        self.count = np.zeros(size + 1)  # open sequences by gap
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # their ranges (first, count)
        self.places: list[tuple[int, int, int, int, int]] = []

    def _take(self, gap: int, many: int) -> list[tuple[int, int]]:
        out = []
        while many:
            first, count = self.open[gap].pop()
            used = min(count, many)
            if used < count:
                self.open[gap].append((first + used, count - used))
            out.append((first, used))
            many -= used
        return out

    def _gap(self, length: int, many: int) -> int:
        """The gap to place into, the whole size being a new sequence: least growth of the squares for each document."""
        count, size = self.count, self.size
        if length == size:
            return size
        have = count[length:size]
        used = np.minimum(have, many)
        after = count[: size - length].copy()
        after[0] = 0  # a full sequence is no longer open
        grow = 2 * (after - have) + 2 * used
        grow[0] -= used[0]
        grow[have == 0] = np.inf
        at = int(grow.argmin())
        if np.isfinite(grow[at]):  # an open one if any fits: as few sequences as can be
            return length + at
        return size

    def _each(self, length: int, many: int) -> dict[int, int]:
        """How many documents go into sequences of each gap when one after another takes the gap of ``_gap``."""
        size = self.size
        if length == size:
            return {size: many}
        if many == 1:
            return {self._gap(length, 1): 1}
        gaps = np.flatnonzero(self.count[length:size]) + length
        room = int((self.count[gaps] * (gaps // length)).sum())
        if many < room:
            return self._least(length, many, gaps)
        # every open sequence is filled, whatever the order; then new ones are, one after another
        used: dict[int, int] = {}
        for gap, n in zip(gaps.tolist(), self.count[gaps].astype(int).tolist()):
            for g in range(gap, length - 1, -length):
                used[g] = used.get(g, 0) + n
        full, rest = divmod(many - room, size // length)
        for i, g in enumerate(range(size, length - 1, -length)):
            if full + (i < rest):
                used[g] = used.get(g, 0) + full + (i < rest)
        return used

    def _least(self, length: int, many: int, gaps: np.ndarray) -> dict[int, int]:
        """``_each`` where open sequences have room for all: a heap of the growth by gap, of which a document changes three."""
        top, used = self.size + 1, {}
        below = np.where(gaps > length, self.count[gaps - length], 0)
        grow = 2 * (below - self.count[gaps]) + np.where(gaps > length, 2, 1)
        heap = np.sort(grow.astype(np.int64) * top + gaps).tolist()  # sorted, so a heap; ties to the smaller gap
        now = {key % top: key for key in heap}
        count = self.count.astype(int).tolist()
        while many:
            key = heap[0]
            gap = key % top
            if now.get(gap) != key:
                heappop(heap)  # it has changed since
                continue
            used[gap] = used.get(gap, 0) + 1
            many -= 1
            count[gap] -= 1
            left, above = gap - length, gap + length
            if left:
                count[left] += 1
            for g in (gap, left, above):
                if length <= g < self.size and count[g]:
                    grown = 2 * (count[g - length] - count[g]) + 2 if g > length else 1 - 2 * count[g]
                    now[g] = grown * top + g
                    heappush(heap, now[g])
            if not count[gap]:
                now[gap] = None
        return used

    def add(self, length: int, rank: int, many: int) -> None:
        """Places so many documents of a length, ranks from ``rank`` on; wide gaps first, as they leave others."""
        for gap, used in sorted(self._each(length, many).items(), reverse=True):
            if gap == self.size:
                ranges = [(self.made, used)]
                self.made += used
            else:
                ranges = self._take(gap, used)
                self.count[gap] -= used
            left = gap - length
            for first, count in ranges:
                self.places.append((length, rank, count, first, self.size - gap))
                rank += count
                if left:
                    self.open[left].append((first, count))
            if left:
                self.count[left] += used


def pack_counts(counts: dict[int, int], size: int, steps: int = STEPS) -> tuple[np.ndarray, int]:
    """Places of all documents, sorted by length and rank, and the number of sequences, from the number of each length.

    Longest first, each document by itself, for any number of documents and of ``steps``.
    """
    packer = Packer(size)
    for length in sorted(counts, reverse=True):
        packer.add(length, 0, counts[length])
    places = np.array(packer.places, np.int64).reshape(-1, 5)
    return places[np.lexsort((places[:, 1], places[:, 0]))], packer.made


def packed(docs: DataFrame, path: str, size: int = 4096, end: int = 1, steps: int = STEPS, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of (doc_id, text).

    A null text is empty and still holds the id ``end``. Each row counts, with null or repeated ids too; other columns are
    left out. Sequences are numbered from 0, their pieces lie gapless from offset 0. An empty table has no pieces.

    The driver gets the counts of at most ``size`` lengths and sends out a place or more for each length and gap that meet
    (48,372 for 15 million documents with lengths drawn from the test documents').
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, path, size, end, keep_ids), "packing-pieces")
    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, _ = pack_counts(counts, size, steps)
    shared = spark.sparkContext.broadcast(places)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    bases = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("local"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        shift = 1 << 40
        keys = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            sequence = table[at, 3] + rank - table[at, 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(table[at, 4])], [*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(run, schema)
