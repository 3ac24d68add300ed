"""Removal of long repeated byte strings with a sparse, sorted suffix array.

Every string of ``length`` bytes has one anchor: the position of its least token, a token being ``TOKEN`` bytes
coded in 64 bits. Equal strings have equal anchors at equal offsets, so strings starting at successive positions
with one anchor travel as one record (code of the anchor's token, code of all its bytes, document, first start,
number of starts).

1. Records are range-partitioned by (code, bytes, document, start) at sampled splitters and sorted. Of records equal in
   all bytes, all but the first repeat whole. A record that is first of its bytes only matters if other records share
   its anchor's code; at the edges of a bucket, where the neighbour is in another one, it stays.
2. The bytes of the remaining records join them. A string holds its anchor's token and what follows it, or what goes
   before it, for ``reach`` bytes; so each record is split in two halves with the longer code of that. They are
   range-partitioned by it; within a bucket all suffixes (string starts) of a code are sorted by multikey quicksort on
   their tokens, and all but the first of equal strings are marked.
3. A code that filled a whole bucket in step 1, or holds over ``PIECE`` bytes, is sorted in pieces. What is first in its
   piece is compared across pieces by a 128-bit code of the whole string.

So no task needs all suffixes of a code, however many documents share it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, in_batches, ragged, text_bytes, whole, written
from millrace.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = 25
#: Text positions coded at once in a task.
BLOCK = 200_000
#: A place packs the first start, the anchor's distance from it, and the number of starts.
STEP = 7
START, LOW = 2 * STEP, (1 << STEP) - 1
#: A code with more bytes of records than this is sorted in pieces.
PIECE = 48_000_000
#: Strings sorted at once.
MANY = 1_500_000
NO_ID = -(2**63)


# Token codes and anchors


def _byte_codes() -> np.ndarray:
    """256 odd-looking 64-bit numbers from a splitmix sequence."""
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE = _byte_codes()
BASE = 0x9E3779B97F4A7C15 | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def token_codes(body: np.ndarray, size: int = TOKEN) -> np.ndarray:
    """64-bit code of the ``size`` bytes from each position on; empty if the body is shorter.

    A polynomial over byte codes, built by doubling: codes of 1, 2, 4, ... bytes are combined as ``size`` needs.
    """
    n = len(body) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, done = BYTE[body], 1, 0
    out = None
    while True:
        if size & width:
            # what is done so far lies before this piece
            piece = power[done : done + n]
            out = piece.copy() if out is None else out * _power(width) + piece
            done += width
        if done == size:
            break
        power = power[:-width] * _power(width) + power[width:]
        width *= 2
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width], for each i that has so many."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


PLACE_BITS = np.uint64(24)  # a block has fewer positions


NONE = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)


def anchors(body: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(code, code of all its bytes, first start, anchor after it, starts) of each record, in order of position, for texts that begin at ``at`` in ``body``.

    Codes are compared by their upper 40 bits, then by position, so the leftmost of equal tokens is taken.
    """
    codes = token_codes(body)
    n = len(body) - length + 1
    if n <= 0:
        return NONE
    low = np.uint64((1 << int(PLACE_BITS)) - 1)
    packed = (codes & ~low) | np.arange(len(codes), dtype=np.uint64)
    place = (sliding_min(packed, length - TOKEN + 1) & low).astype(np.int64)
    # starts whose string would leave its text
    ends = at[1:]
    bad = np.zeros(n + 1, np.int32)
    first_bad = np.clip(ends - length + 1, at[:-1], None)
    np.add.at(bad, np.minimum(first_bad, n), 1)
    np.add.at(bad, np.minimum(ends, n), -1)
    valid = np.cumsum(bad[:-1]) == 0
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    if not len(starts):
        return NONE
    stop = np.ones(n, bool)
    stop[:-1] = (place[1:] != place[:-1]) | ~valid[1:]
    stops = np.flatnonzero(stop & valid)
    count = stops - starts + 1
    # tokens side by side, the last one ending where the record ends
    final = stops + length - TOKEN
    every = count.astype(np.uint64)
    with np.errstate(over="ignore"):
        for step in range(0, 2 * length - TOKEN, TOKEN):
            every = (every ^ codes[np.minimum(starts + step, final)]) * np.uint64(0x94D049BB133111EB)
            every ^= every >> np.uint64(30)
    return codes[place[starts]], every, starts, place[starts] - starts, count


def text_anchors(text: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, code, code of all bytes, first start within its text, anchor after it, starts), a block of texts at a time; a longer text in pieces that overlap."""
    body, at = text_bytes(text)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK, side="right")) - 1)
        if at[last] - at[row] <= BLOCK:
            own = at[row : last + 1] - at[row]
            code, every, start, off, n = anchors(body[at[row] : at[last]], own, length)
            of = np.searchsorted(own, start, side="right") - 1
            yield row + of, code, every, start - own[of], off, n
        else:
            one = body[at[row] : at[last]]
            for begin in range(0, max(1, len(one) - length + 1), BLOCK):
                piece = one[begin : begin + BLOCK + length - 1]
                code, every, start, off, n = anchors(piece, np.array([0, len(piece)]), length)
                yield np.full(len(start), row), code, every, start + begin, off, n
        row = last


# Multikey quicksort


def multikey_order(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): positions sorted by their tokens, first token first, and where a run of equal keys begins.

    As in multikey quicksort, only runs equal in all tokens so far go on to the next token.
    """
    n = len(tokens[0])
    order = np.argsort(tokens[0])
    new = np.ones(n, bool)
    new[1:] = tokens[0][order][1:] != tokens[0][order][:-1]
    for token in tokens[1:]:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        members, run = order[at], np.cumsum(new)[at]
        key = token[members]
        # runs differing in this token only split; most do not, and need no sort
        differs = (key[1:] != key[:-1]) & (run[1:] == run[:-1])
        if differs.any():
            again = np.isin(run, run[1:][differs])
            sub = np.flatnonzero(again)
            inner = np.lexsort((members[sub], key[sub], run[sub]))
            order[at[sub]] = members[sub][inner]
            key[sub] = key[sub][inner]
            split = np.zeros(len(at), bool)
            split[1:] = (run[1:] == run[:-1]) & (key[1:] != key[:-1])
            new[at[split]] = True
    return order, new


def repeats(record: np.ndarray, start: np.ndarray, identity: tuple[np.ndarray, ...], tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(repeated, leads): whether each string repeats an earlier one, and whether it is the first of its kind.

    Strings are in order of document and start as far as they can be equal; ``identity`` says whose records are.
    """
    order, new = multikey_order(tokens)
    heads = np.flatnonzero(new)
    earliest = np.minimum.reduceat(order, heads) if len(heads) else np.zeros(0, np.int64)
    lead = np.empty(len(order), np.int64)
    lead[order] = np.repeat(earliest, np.diff(np.append(heads, len(order))))
    same = start == start[lead]  # the same start of a row that is there twice
    for column in identity:
        same &= column[record] == column[record[lead]]
    return ~same, lead == np.arange(len(lead))


def string_codes(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit code of each string in two halves."""
    with np.errstate(over="ignore"):
        one, two = (np.zeros(len(tokens[0]), np.uint64) for _ in range(2))
        for t in tokens:
            one = (one ^ t) * np.uint64(0x94D049BB133111EB) + np.uint64(1)
            one ^= one >> np.uint64(31)
            two = (two + t) * np.uint64(0xD6E8FEB86659FD93)
            two ^= two >> np.uint64(32)
    return one.view(np.int64), two.view(np.int64)


# The job


def _records(docs: DataFrame, length: int) -> DataFrame:
    """(code, every, doc, tag, place) of every record; place packs first start and number of starts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 8, 2):
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, code, every, start, off, n in text_anchors(batch.column(2), length):
                columns = [code.view(np.int64), every.view(np.int64), doc[row], tag[row], start << START | off << STEP | n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["code", "every", "doc", "tag", "place"])

    return docs.select("doc", "tag", "body").mapInArrow(run, "code long, every long, doc long, tag long, place long")


def _shared(sorted_records: DataFrame) -> DataFrame:
    """(whole, code, doc, tag, place) from sorted buckets: records that repeat whole, and firsts whose code is shared.

    The first and the last first of a bucket stay in any case. A bucket with one code only adds a row with place -1.
    """

    def out(whole: bool, code: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(doc), whole)), *[pa.array(c) for c in (code, doc, tag, place)]]
        return pa.RecordBatch.from_arrays(columns, ["whole", "code", "doc", "tag", "place"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None  # the first of the bytes seen last
        held, stays = np.zeros((5, 0), np.int64), True  # the last first, until its neighbour is known
        codes: set[int] = set()  # at most two
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            codes = {*codes, int(rows[0, 0]), int(rows[0, -1])} if len(codes) < 2 else codes
            if first is not None:
                rows = np.concatenate([first, rows], axis=1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            repeated = (rows[2:] != rows[2:, lead]).any(0)  # not so: the same row once more
            if repeated.any():
                part = rows[:, repeated]
                yield out(True, np.zeros_like(part[0]), *part[2:])
            if first is not None:
                new[0] = False  # counted before
            first = rows[:, lead[-1:]]
            leads = np.concatenate([held, rows[:, new]], axis=1)
            if not leads.shape[1]:
                continue
            keep = np.zeros(leads.shape[1], bool)
            equal = leads[0, 1:] == leads[0, :-1]
            keep[1:] |= equal
            keep[:-1] |= equal
            keep[0] |= stays
            held, stays = leads[:, -1:], bool(keep[-1])
            part = leads[:, :-1][:, keep[:-1]]
            yield out(False, part[0], *part[2:])
        if held.shape[1]:
            yield out(False, held[0], *held[2:])
        if len(codes) == 1:
            yield out(False, np.array([*codes]), *np.array([[0], [0], [-1]]))

    return sorted_records.mapInArrow(run, "whole boolean, code long, doc long, tag long, place long")


def reach(length: int) -> int:
    """Bytes beyond its token that a half's code takes in, on one side: every string holds so many on one of them."""
    return (length - TOKEN) // 2


def _with_bytes(joined: DataFrame, length: int, full: dict[int, int]) -> DataFrame:
    """(code, doc, tag, place, open, bytes) of both halves of the records, from rows (doc, tag, body, places).

    ``full`` has the codes that are to be dealt to so many pieces; their rows are open.
    """
    far = reach(length)
    some = np.array(sorted(full), np.int64)
    pieces = np.array([full[c] for c in sorted(full)], np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 8, 2):
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            body, at = text_bytes(batch.column(2))
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            row = np.repeat(np.arange(len(doc)), np.diff(bounds))
            entries = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
            whole, code, place = (entries.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            mine = ~whole & (place >= 0)
            row, code, place = row[mine], code[mine], place[mine]
            start, off, n = place >> START, place >> STEP & LOW, place & LOW
            left = np.clip(off - far, 0, n)  # so many starts lie further than that before the anchor
            begin = [np.zeros_like(n), left]
            size = [left, n - left]
            for half in (0, 1):
                has = np.flatnonzero(size[half] > 0)
                for x in range(0, len(has), 10_000):
                    i = has[x : x + 10_000]
                    first, count = start[i] + begin[half][i], size[half][i]
                    span = count + length - 1
                    data = body[ragged(at[row[i]] + first, span)]
                    offsets = np.concatenate([[0], np.cumsum(span)])
                    grams = token_codes(data)
                    anchor = offsets[:-1] + off[i] - begin[half][i]
                    with np.errstate(over="ignore"):
                        longer = grams[anchor] * _power(3) + grams[anchor + (far if half else -far - 1)] * _power(5) + np.uint64(half)
                        if len(some):
                            known = np.minimum(np.searchsorted(some, code[i]), len(some) - 1)
                            is_open = some[known] == code[i]
                            part = (doc[row[i]].astype(np.uint64) * np.uint64(BASE) >> np.uint64(33)) % pieces[known]
                            longer = np.where(is_open, longer + part * _power(7), longer)
                        else:
                            is_open = np.zeros(len(i), bool)
                    packed = first << START | (off[i] - begin[half][i]) << STEP | count
                    binary = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
                    columns = [pa.array(c) for c in (longer.view(np.int64), doc[row[i]], tag[row[i]], packed, is_open)]
                    yield pa.RecordBatch.from_arrays([*columns, binary], ["code", "doc", "tag", "place", "open", "bytes"])

    schema = "code long, doc long, tag long, place long, open boolean, bytes binary"
    return joined.select("doc", "tag", "body", "places").mapInArrow(run, schema)


CHUNK = 500_000  # bytes of records gathered before they are sorted


def _marked(sorted_suffixes: DataFrame, length: int) -> DataFrame:
    """From sorted buckets: repeated stretches (doc, tag, start, stop), and strings to compare across pieces (with one, two)."""

    def rows_of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "tag", "start", "stop", "across", "one", "two"])

    def judge(rows: pa.Table, cut: bool) -> Iterator[pa.RecordBatch]:
        """``cut``: the rows are a piece of one code."""
        code, doc, tag, place, is_open = (rows.column(k).to_numpy() for k in ("code", "doc", "tag", "place", "open"))
        is_open = np.ones_like(is_open) if cut else is_open
        alone = np.ones(len(code), bool)  # no other record of the code: nothing to compare
        alone[1:] &= code[1:] != code[:-1]
        alone[:-1] &= code[1:] != code[:-1]
        rows = rows.filter(pa.array(~alone | is_open))
        code, doc, tag, place, is_open = (c[~alone | is_open] for c in (code, doc, tag, place, is_open))
        if not len(code):
            return
        body, at = text_bytes(rows.column("bytes"))
        first, off, n = place >> START, place >> STEP & LOW, place & LOW
        base = np.cumsum(n) - n
        record, step = np.repeat(np.arange(len(n)), n), ragged(np.zeros(len(n), np.int64), n)
        grams = token_codes(body)
        offsets = [*range(0, length - TOKEN, TOKEN), length - TOKEN]
        sets = [np.arange(len(record))]
        if len(record) > MANY:  # equal strings have their anchors at equal offsets
            by_offset = np.argsort(off[record] - step, kind="stable")
            at_offset = (off[record] - step)[by_offset]
            sets = np.split(by_offset, np.flatnonzero(at_offset[1:] != at_offset[:-1]) + 1)
        repeated = np.zeros(len(record), bool)
        for chosen in sets:
            r, s = record[chosen], step[chosen]
            tokens = [grams[at[r] + s + k] for k in offsets]
            repeated[chosen], leads = repeats(r, first[r] + s, (doc, tag), tokens)
            out = np.flatnonzero(leads & is_open[r])
            if len(out):
                of, start = r[out], (first[r] + s)[out]
                one, two = string_codes([t[out] for t in tokens])
                yield rows_of(doc[of], tag[of], start, start + length, np.ones(len(out), bool), one, two)
        hit = np.flatnonzero(repeated)
        if len(hit):
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) != 1) | (np.diff(record[hit]) != 0)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(hit)) - 1
            of = record[hit[begin]]
            start, stop = (first[record] + step)[hit[begin]], (first[record] + step)[hit[end]] + length
            # a key of its own for each stretch: it meets nothing in the comparison across pieces
            with np.errstate(over="ignore"):
                own = (doc[of].astype(np.uint64) * np.uint64(BASE)) ^ (start.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                own ^= own >> np.uint64(32)
            yield rows_of(doc[of], tag[of], start, stop, np.zeros(len(of), bool), own.view(np.int64), start)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, cut = 0, None  # cut: a code that has had a piece already
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < CHUNK:
                continue
            if held[0].column("code")[0] == held[-1].column("code")[-1] and size < PIECE:
                continue  # one code so far
            rows = pa.concat_tables(held).combine_chunks()
            code = rows.column("code").to_numpy()
            last = int(np.searchsorted(code, code[-1], side="left"))
            if last:
                begin = int(np.searchsorted(code, cut, side="right")) if cut is not None else 0
                if begin:
                    yield from judge(rows.slice(0, begin), True)
                yield from judge(rows.slice(begin, last - begin), False)
                held, size, cut = [rows.slice(last)], rows.slice(last).nbytes, None
            else:
                cut = int(code[0])
                yield from judge(rows, True)
                held, size = [], 0
        if held:
            rows = pa.concat_tables(held).combine_chunks()
            begin = int(np.searchsorted(rows.column("code").to_numpy(), cut, side="right")) if cut is not None else 0
            if begin:
                yield from judge(rows.slice(0, begin), True)
            yield from judge(rows.slice(begin), False)

    schema = "doc long, tag long, start long, stop long, across boolean, one long, two long"
    return sorted_suffixes.mapInArrow(run, schema)


def repeated_places(bodies: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Of the documents (doc, tag, body): (doc, tag, places) with the records that repeat whole, and (doc, tag, spans)
    with the stretches (start, stop) found repeated in others; they may overlap."""
    if not 2 * TOKEN <= length <= TOKEN + LOW - 1:
        raise ValueError(f"length must be from {2 * TOKEN} to {TOKEN + LOW - 1}")
    n = parallelism(bodies.sparkSession)
    key = ["code", "every", "doc", "tag", "place"]
    records = _records(bodies, length).repartitionByRange(n, *key).sortWithinPartitions(*key)
    shared = written(_shared(records), "suffix-records")
    # codes that fill buckets: as many rows as buckets at most
    full: dict[int, int] = {}
    for r in shared.filter("place = -1").select("code").collect():
        full[r["code"]] = full.get(r["code"], 1) + 1
    by_doc = shared.filter("place >= 0").groupBy("doc", "tag").agg(F.collect_list(F.struct("whole", "code", "place")).alias("places"))
    halves = _with_bytes(bodies.join(by_doc, ["doc", "tag"]), length, full)
    marked = _marked(halves.repartitionByRange(n, "code").sortWithinPartitions("code", "doc", "tag", "place"), length)
    firsts = marked.groupBy("one", "two", "across").agg(
        F.min(F.struct("doc", "tag", "start")).alias("least"), F.collect_list(F.struct("doc", "tag", "start", "stop")).alias("all")
    )
    later = F.filter("all", lambda s: ~F.col("across") | (F.struct(s["doc"], s["tag"], s["start"]) > F.col("least")))
    spans = firsts.select(F.explode(later).alias("s")).select("s.*")
    return by_doc, spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _bodies(docs: DataFrame, *more) -> DataFrame:
    """(doc, tag, body): doc_id with null as the least long, and a tag that tells rows of one doc_id apart by text.

    The tag is only needed where a doc_id is missing or repeated; elsewhere it is zero.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long"))
    ids = docs.select(doc.alias("doc"))
    unique = not ids.groupBy("doc").count().filter(f"count > 1 or doc = {NO_ID}").limit(1).count()
    text = whole("text") if dict(docs.dtypes)["text"] == "string" else F.coalesce("text", F.lit(b""))
    tag = F.lit(0).cast("long") if unique else F.xxhash64(text)
    return docs.select(doc.alias("doc"), tag.alias("tag"), text.alias("body"), *more)


def merged(places: list[dict] | None, spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal stretches covered by the places that repeat whole and the spans; stretches that touch are one."""
    found = [(s["start"], s["stop"]) for s in spans or []]
    for p in places or []:
        if p["whole"]:
            start = p["place"] >> START
            found.append((start, start + (p["place"] & LOW) + length - 1))
    out: list[tuple[int, int]] = []
    for start, stop in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def without(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return body
    parts, at = [], 0
    for start, stop in spans:
        parts.append(body[at:start])
        at = stop
    return b"".join([*parts, body[at:]])


def _joined(docs: DataFrame, length: int, *more) -> DataFrame:
    bodies = _bodies(docs, *more)
    by_doc, spans = repeated_places(bodies.select("doc", "tag", "body"), length)
    return bodies.join(by_doc, ["doc", "tag"], "left").join(spans, ["doc", "tag"], "left")


def suffix_report(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is left, for every row.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one. Strings are judged on the input. Null texts are empty; documents without doc_id come
    first, and those that share a doc_id follow each other by a hash of their text; equal rows are one document
    and get one answer.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, places, spans in zip(*batch.columns[1:]):
                body = body.as_buffer().to_pybytes()
                gone = merged(places.as_py(), spans.as_py(), length)
                kept = without(body, gone)
                out.append((len(body), len(body) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
            a, b, c, d = zip(*out) if out else ((), (), (), ())
            columns = [batch.column(0), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _joined(docs, length).select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "body", "places", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """The documents with repeated bytes taken out of ``text``; other columns stay as they are.

    A character that loses some of its bytes goes whole. A null text becomes empty.
    """
    row, new = fresh(docs, "_row", "_kept")
    others = [c for c in docs.columns if c.lower() != "text"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, places, spans in zip(*batch.columns[1:]):
                body = body.as_buffer().to_pybytes()
                gone = merged(places.as_py(), spans.as_py(), length)
                out.append(without(body, gone).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [row, new])

    joined = _joined(docs, length, F.struct(*[F.col(f"`{c}`") for c in others]).alias(row)).select(row, "body", "places", "spans")
    kept = joined.mapInArrow(cut, joined.select(row, F.col("body").alias(new)).schema)
    return kept.select(*[F.col(new).alias(c) if c.lower() == "text" else F.col(row)[c].alias(c) for c in docs.columns])
