"""Token counts of fields and sections: encode the whole document once, then lay token spans over section spans."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, kept_in_process, ragged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RULES = ("largest", "first", "share")


class Tokens:
    """Encodes with a rank file and knows the bytes of each token."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)


def character_spans(body: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character span of each token, tokens covering the UTF-8 bytes ``body`` in turn.

    A token that holds some bytes of a character spans it, so the tokens of a split character overlap there.
    """
    begins = (body & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])
    stop = np.cumsum(size)
    start = stop - size
    first = before[start] - np.where(begins[start], 0, 1) if len(start) else before[:0]
    return first, before[stop]


def allocate(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) of each section, sections being [bounds[i], bounds[i + 1]).

    A token inside one section counts there. One that crosses a boundary counts where it has most characters, the
    earlier section if equal (``largest``), where it begins (``first``), or by its characters in each (``share``).
    ``crossing`` counts the tokens that touch a section without lying in it.
    """
    sections = len(bounds) - 1
    of = np.searchsorted(bounds, first, side="right") - 1
    until = np.searchsorted(bounds, last - 1, side="right") - 1
    inside = of == until
    tokens = np.bincount(of[inside], minlength=sections).astype(float)
    crossing = np.zeros(sections, np.int64)
    cross = np.flatnonzero(~inside)
    if len(cross):
        n = until[cross] - of[cross] + 1
        token, section = np.repeat(np.arange(len(cross)), n), ragged(of[cross], n)
        overlap = np.minimum(last[cross][token], bounds[section + 1]) - np.maximum(first[cross][token], bounds[section])
        np.add.at(crossing, section[overlap > 0], 1)
        if rule == "share":
            np.add.at(tokens, section, overlap / (last - first)[cross][token])
        elif rule == "first":
            np.add.at(tokens, of[cross], 1)
        else:
            order = np.lexsort((section, -overlap, token))
            heads = order[np.flatnonzero(np.append(True, token[order][1:] != token[order][:-1]))]
            np.add.at(tokens, section[heads], 1)
    return tokens, crossing


def sections_of(fields: Sequence[str], values: Sequence[str | None], split: str | None) -> tuple[str, list[str], list[str]]:
    """(whole text, names, parts): fields in turn, each closed by a line end, the ``split`` field line by line.

    A line end belongs to what it closes; the last line of a field has the field's. Null fields are empty.
    """
    names, parts = [], []
    for name, value in zip(fields, values):
        value = (value or "") + "\n"
        pieces = [p + "\n" for p in value[:-1].split("\n")] if name == split else [value]
        names += [name] * len(pieces)
        parts += pieces
    return "".join(parts), names, parts


def section_tokens(
    docs: DataFrame, path: str, pattern: str, fields: Sequence[str] = ("source", "lang", "text"), split: str | None = "text", rule: str = "largest"
) -> DataFrame:
    """(doc_id, section, field, start, stop, n_tokens, n_crossing) for every section of every row.

    The document is its ``fields`` in turn, each closed by a line end; the field ``split`` has a section for each
    line. Start and stop are characters of the document. Every row is encoded once, as a whole; the tokens of a row add up
    to n_tokens of its sections. Null fields are empty and still have their section; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept_in_process(("tokens", path, pattern), lambda: Tokens(path, pattern))
        for batch in in_batches(batches, 4, len(fields)):
            rows = list(zip(*[c.to_pylist() for c in batch.columns[1:]]))
            texts, names, numbers, lengths, count, ids = [], [], [], [], [], []
            for values in rows:
                text, named, parts = sections_of(fields, values, split)
                texts.append(text)
                names += named
                numbers += range(len(parts))
                lengths += map(len, parts)
                count.append(len(parts))
                ids += tokens.encode(text)
            if not rows:
                continue
            body = np.frombuffer("".join(texts).encode(), np.uint8)
            first, last = character_spans(body, tokens.size[np.array(ids, np.int64)])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            n, crossing = allocate(first, last, bounds, rule)
            row = np.repeat(np.arange(len(rows)), count)
            origin = np.repeat(bounds[np.cumsum(count) - count], count)
            columns = [
                batch.column(0).take(pa.array(row)), pa.array(numbers, pa.int32()), pa.array(names, pa.string()),
                pa.array(bounds[:-1] - origin), pa.array(bounds[1:] - origin),
                pa.array(n if rule == "share" else n.astype(np.int64)), pa.array(crossing),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "section", "field", "start", "stop", "n_tokens", "n_crossing"])

    kind = "double" if rule == "share" else "long"
    schema = f"doc_id long, section int, field string, start long, stop long, n_tokens {kind}, n_crossing long"
    return docs.select(F.col("doc_id").cast("long"), *[F.col(f).cast("string") for f in fields]).mapInArrow(run, schema)
