"""Byte-level BPE as a finite-state transducer that is determinised while it runs.

Which token ends a prefix follows from which tokens end shorter prefixes: a token may follow another if the merges
would not have joined them otherwise. After some bytes there are several open readings, one per suffix that begins
a token. A state of the transducer holds the open suffixes with what each has yet to emit; what all readings agree on
is emitted at once, so the delay is bounded by the longest token. States and transitions are worked out when first met
and kept, and so are the tokens of pieces met before.

Decoding looks up token bytes; text leaves an incremental UTF-8 state machine that holds back unfinished characters.
"""

from __future__ import annotations

import base64
import hashlib
import marshal
import sys
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, kept_in_process, ragged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States kept; beyond, the tables start anew. Bounds the memory of a task at about 1 KB a state.
MAX_STATES = 200_000
#: Pieces whose tokens are kept for later batches.
MAX_PIECES = 150_000
LISTS = 24  # bits of a move for the number of the emitted tokens
NO_LIST = (1 << LISTS) - 1
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Transducer:
    """Encodes pieces of bytes to token ids by the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.prefixes = {token[:k] for token in ranks for k in range(1, len(token) + 1)}
        self.by_id = {i: token for token, i in ranks.items()}
        # least rank of a token that starts with one token and goes on with a byte
        self.joins: dict[tuple[bytes, int], int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if token[:k] in ranks and token[k:] in ranks:
                    key = (token[:k], token[k])
                    self.joins[key] = min(rank, self.joins.get(key, NEVER))
        self.spines: dict[tuple[bool, int], tuple] = {}
        self.same: dict[tuple, int] = {}
        self.alike: dict[tuple[int, int], int] = {}
        self.may: dict[tuple[int, int], bool] = {}
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.states: list[bytes] = []  # packed, as there are many
        self.ends: list[tuple] = []  # tokens emitted if the piece ends in a state
        self.moves: dict[int, int] = {}  # state and byte: next state and number of the tokens emitted
        self.emitted: dict[tuple, int] = {}
        self.lists: list[tuple] = []
        self._list(())
        self._state(b"", ((0, (-1,)),))

    # which tokens may follow each other

    def _spine(self, token: int, right: bool) -> tuple[tuple[bytes, int], ...]:
        """The last (first) piece of a token while it is merged, with the rank at which the piece is taken up."""
        found = self.spines.get((right, token))
        if found is None:
            out, piece, upto = [], self.by_id[token], NEVER
            while True:
                out.append((piece, upto))
                parts = self.merge(piece, 2)
                if len(parts) != 2:
                    break
                upto, piece = self.ranks[piece], parts[1] if right else parts[0]
            found = self.spines[right, token] = tuple(out)
        return found

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens by rank leaves just these two.

        It does unless a piece at the end of the left one joins a piece at the start of the right one before either
        is taken up; at equal rank the leftmost merge comes first. Ranks grow with the merges, so this is all.
        """
        if left < 0:
            return True
        known = self.may.get((left, right))
        if known is None:
            if len(self.may) > MAX_PIECES:
                self.may.clear()
            known, rank_of = True, self.ranks.get
            first = self._spine(right, False)
            for piece, upto in self._spine(left, True):
                for other, until in first:
                    rank = rank_of(piece + other, NEVER)
                    if rank < upto and rank <= until and rank < NEVER:
                        known = False
            self.may[left, right] = known
        return known

    def _class(self, token: int, byte: int) -> int:
        """One token for all that let the same tokens beginning with the byte follow; -1 for those that let all."""
        if token < 0:
            return -1
        found = self.alike.get((token, byte))
        if found is None:
            if len(self.alike) > MAX_PIECES:
                self.alike.clear()
            relevant = tuple((piece, upto) for piece, upto in self._spine(token, True) if self.joins.get((piece, byte), NEVER) < upto)
            found = self.alike[token, byte] = self.same.setdefault((byte, relevant), token) if relevant else -1
        return found

    def merge(self, piece: bytes, upto: int = 1) -> tuple[bytes, ...]:
        """Merge pairs by rank, leftmost first, until ``upto`` pieces are left or none can be merged."""
        pieces = [piece[i : i + 1] for i in range(len(piece))]
        while len(pieces) > upto:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:])))
            if rank == NEVER:
                break
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return tuple(pieces)

    # A state is (open text, ((length of an open suffix, path to it), ...)). A path holds the tokens not yet emitted, after
    # the last one emitted or any of its class, -1 if that does not matter.

    def _state(self, text: bytes, readings: tuple) -> int:
        key = marshal.dumps((text, readings), 2)
        number = self.numbers.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
            # at the end the reading counts in which a token has just ended
            self.ends.append(self.lists[self._list(readings[0][1][1:])])
        return number

    def _list(self, tokens: tuple) -> int:
        number = self.emitted.setdefault(tokens, len(self.lists))
        if number == len(self.lists):
            self.lists.append(tokens)
        return number

    def _step(self, number: int, byte: int) -> int:
        text, readings = marshal.loads(self.states[number])
        text += bytes((byte,))
        size = len(text)
        # the token that ends here: the longest that may follow what ends where it begins
        here = None
        for k, path in reversed(readings):
            token = self.ranks.get(text[size - k - 1 :])
            if token is not None and self.follows(path[-1], token):
                here = (*path, token)
                break
        if here is None:
            raise ValueError(f"byte {byte} is no token")
        still = [(0, here)] + [(k + 1, path) for k, path in readings if text[size - k - 1 :] in self.prefixes]
        # emit what all readings share
        first = min((path for _, path in still), key=len)
        share = 1
        while share < len(first) and all(path[share] == first[share] for _, path in still):
            share += 1
        longest = still[-1][0]
        text = text[size - longest :]
        marker = -1
        for k, path in still:
            if len(path) == share:  # a token may begin right after what is emitted
                marker = self._class(path[-1], text[-k]) if k else path[-1]
        kept = tuple((k, (marker, *path[share:])) for k, path in still)
        move = self.moves[number << 8 | byte] = self._state(text, kept) << LISTS | self._list(first[1:share])
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of a piece; an empty one has none."""
        if len(self.states) > MAX_STATES:
            self._empty()
        out: list[int] = []
        state, known, lists = 0, self.moves.get, self.lists
        for byte in piece:
            move = known(state << 8 | byte) or self._step(state, byte)
            state = move >> LISTS
            if move & NO_LIST:
                out += lists[move & NO_LIST]
        out += self.ends[state]
        return out


class Numbers(dict):
    """Numbers pieces as they first come."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Encoder:
    """Splits texts by a pattern and encodes the pieces; remembers the tokens of pieces met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.counts = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and where each text's begin (one more entry than texts)."""
        if len(self.known) > MAX_PIECES:
            self._forget()
        known, found = self.known, [self.find(text) for text in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        before = len(known)
        which = np.fromiter(map(known.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
        if len(known) > before:
            coded = [self.transducer.encode(p.encode("utf-8", "surrogatepass")) for p in islice(known, before, None)]
            counts = np.fromiter(map(len, coded), np.int64, len(coded))
            ids = np.fromiter(chain.from_iterable(coded), np.uint32, int(counts.sum()))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        starts = np.cumsum(self.counts) - self.counts
        ids = self.ids[ragged(starts[which], self.counts[which])]
        upto = np.concatenate([[0], np.cumsum(self.counts[which])])
        return ids, upto[np.append(0, np.cumsum(sizes))]


class Decoder:
    """Token ids to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.size = np.zeros(size, np.int64)
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
            self.size[i] = len(token)
        self.start = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.body[ragged(self.start[ids], self.size[ids])].tobytes()


class Utf8Stream:
    """Bytes in any chunks to text: complete characters leave at once, an unfinished one waits for its rest.

    The state is how many bytes of a character are still due and those seen. Bytes that cannot be part of a
    character become U+FFFD.
    """

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def due(chunk: bytes) -> int:
        """Bytes at the end of the chunk that begin a character without ending it."""
        for back in range(1, min(3, len(chunk)) + 1):
            byte = chunk[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < need and byte < 0xF5 else 0
        return 0

    def feed(self, chunk: bytes) -> str:
        chunk = self.waiting + chunk
        held = self.due(chunk)
        self.waiting = chunk[len(chunk) - held :]
        return chunk[: len(chunk) - held].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def _encoder(path: str, pattern: str) -> Encoder:
    return kept_in_process(("bpe", path, pattern), lambda: Encoder(read_ranks(path), pattern))


def _decoder(path: str) -> Decoder:
    return kept_in_process(("bpe-decode", path), lambda: Decoder(read_ranks(path)))


def _streamed(decoder: Decoder, ids: np.ndarray, chunk: int) -> Iterator[str]:
    """The text of the ids, ``chunk`` tokens at a time, as it leaves the UTF-8 machine."""
    stream = Utf8Stream()
    for at in range(0, len(ids), chunk):
        yield stream.feed(decoder.decode(ids[at : at + chunk]))
    yield stream.end()


def _text_sha(decoder: Decoder, ids: np.ndarray, chunk: int) -> str:
    sha = hashlib.sha256()
    for part in _streamed(decoder, ids, chunk):
        sha.update(part.encode())
    return sha.hexdigest()


def encode_documents(docs: DataFrame, path: str, pattern: str, decode: bool = False, chunk: int = 4096) -> DataFrame:
    """doc_id and ids of every row and, with ``decode``, decoded_sha256: of the text that the ids stream back into.

    The rank file must be readable by workers at ``path``. Texts are encoded whole, without special tokens. With ``decode``
    ids that do not give their text back stop the job. Null texts are empty and give no ids; every row, with null or
    repeated doc_id too, gives a row; other columns are left out; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path, pattern), _decoder(path)
        for batch in in_batches(batches, 1, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, at = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            columns, names = [batch.column(0), lists], ["doc_id", "ids"]
            if decode:
                back = [_text_sha(decoder, ids[a:b], chunk) for a, b in zip(at, at[1:])]
                wrong = [i for i, (text, sha) in enumerate(zip(texts, back)) if hashlib.sha256(text.encode()).hexdigest() != sha]
                if wrong:
                    raise ValueError(f"ids do not decode to the text of doc_id {batch.column(0)[wrong[0]].as_py()}")
                columns.append(pa.array(back, pa.string()))
                names.append("decoded_sha256")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, ids array<int>" + ", decoded_sha256 string" * decode
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str, chunk: int = 4096) -> DataFrame:
    """doc_id and text of (doc_id, ids): tokens stream through the UTF-8 machine, ``chunk`` at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches:
            lists = [np.array(ids.as_py() or [], np.int64) for ids in batch.column(1)]
            texts = ["".join(_streamed(decoder, ids, chunk)) for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def encode_digest(docs: DataFrame, path: str, pattern: str, chunk: int = 4096) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids as little-endian 32-bit numbers, and of the text decoded from them.

    Ids are decoded ``chunk`` at a time; what leaves the UTF-8 machine is hashed. A null text is an empty one; every row,
    with null or repeated doc_id too, gives a row; other columns are left out; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path, pattern), _decoder(path)
        for batch in in_batches(batches, 1, 1):
            ids, at = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            ids = ids.astype("<u4")
            spans = list(zip(at.tolist(), at[1:].tolist()))
            coded = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in spans]
            plain = [_text_sha(decoder, ids[a:b], chunk) for a, b in spans]
            columns = [batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
