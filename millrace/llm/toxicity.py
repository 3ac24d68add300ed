"""Toxicity by a noisy channel: restore disguised words, then score the restored text.

Words may hide behind look-alike symbols, single letters set apart, or repeated letters. Each suspicious stretch
becomes a lattice of characters (a symbol may stand for a letter or for nothing, a repeated letter for one letter), and
the Viterbi path under a character trigram model of the corpus is taken as what was meant. A stretch with marks is read
once more with marks that may also end a word. Plain words stay.

What is toxic is learned from labels: words and word beginnings that occur (almost) only in toxic documents, chosen
greedily so that each accounts for enough documents with few signs so far. A document's score is the chance that at least
one of its learned signs tells the truth.
"""

from __future__ import annotations

import re
import string
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled documents that the classifier is fitted on, about; chosen by hash of doc_id among all that may teach.
FIT_ROWS = 20_000
#: Signs that a fitted classifier holds at most.
MAX_SIGNS = 2_000
#: Lengths of word beginnings that may become signs, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
MIN_DOCS, MIN_PRECISION = 5, 0.9
#: What a document still counts for the next sign once it has one more: copies of one text teach little that way.
FADE = 0.6

# Symbols that pass for letters.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Characters of the language model: word edge, letters, anything else.
SYMBOLS = {c: i for i, c in enumerate("^" + LETTERS)}
OTHER, SIZE = len(SYMBOLS), len(SYMBOLS) + 1
# Log costs of the channel.
LOOK, DROP_SYMBOL, DROP_REPEAT, DROP_MARK = -1.0, -6.0, -0.7, -0.3

WORDS = re.compile(r"[^\W\d_]+")
_LOOK = "".join(map(re.escape, LOOKS))
_LETTER = r"[^\W\d_]"
#: A look-alike next to a letter, or a letter twice: the run of non-space around it is suspicious.
HINT = re.compile(rf"[{_LOOK}]{_LETTER}|{_LETTER}[{_LOOK}]|([a-z])\1")
RUN = re.compile(r"\S*")
THRICE = re.compile(r"(.)\1\1")
#: Three or more single characters set apart by marks or white space.
SPACED = re.compile(rf"(?<!{_LETTER})(?:[a-z{_LOOK}](?:[^\w{_LOOK}]|_)++){{2,}}[a-z{_LOOK}](?!{_LETTER})")
_MARK_LOOK = "".join(re.escape(c) for c in LOOKS if not c.isalnum())
#: Three or more single letters set apart by one mark that could pass for a letter itself.
CHAINED = re.compile(rf"(?<!{_LETTER})[a-z]([{_MARK_LOOK}])\1*(?:[a-z]\1+)+[a-z](?!{_LETTER})")
#: Marks that change nothing at the ends of a run.
EDGE = "".join(c for c in string.punctuation if c not in LOOKS)


#: Characters after which restored text is looked through for what is certain, and stretches up to which results are kept.
SETTLE, LONG_STRETCH = 64, 128


class CharModel:
    """Character trigrams with interpolation, in natural logarithms."""

    def __init__(self, counts: np.ndarray):
        tri = counts.astype(float)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        one = (uni + 1) / (uni.sum() + SIZE)
        two = (bi + 5 * one[None, :]) / (bi.sum(1, keepdims=True) + 5)
        three = (tri + 5 * two[None, :, :]) / (tri.sum(2, keepdims=True) + 5)
        self.table = np.log(three).tolist()


def _readings(text: str, at: int, breaks: bool) -> list[tuple[str, float]]:
    """What the character may stand for, with its cost; a blank ends a word."""
    c = text[at]
    if c in SYMBOLS and c != "^":
        out = [(c, 0.0)]
        if at and text[at - 1] == c:
            out.append(("", DROP_REPEAT))
        return out
    ends = [(" ", DROP_MARK)] if breaks and not c.isalnum() else []
    if c in LOOKS:
        return [(x, LOOK) for x in LOOKS[c]] + [("", DROP_SYMBOL)] + ends
    if c.isalpha():
        return [(c, 0.0)]
    return [("", DROP_MARK)] + ends


def restore(text: str, model: CharModel, breaks: bool = False) -> str:
    """The likeliest word behind a stretch of lower-case text: Viterbi over its lattice. With ``breaks`` the likeliest words, as marks may end one."""
    table = model.table
    # by the last two symbols and whether there is a letter yet: value and word
    paths: dict[tuple[int, int, bool], tuple[float, str]] = {(0, 0, False): (0.0, "")}
    settled: list[str] = []
    for at in range(len(text)):
        if not at % SETTLE and at:  # what all paths begin with is certain; they go on without it
            certain = commonprefix([word for _, word in paths.values()])
            if certain:
                settled.append(certain)
                paths = {key: (value, word[len(certain) :]) for key, (value, word) in paths.items()}
        following: dict[tuple[int, int, bool], tuple[float, str]] = {}
        for c, cost in _readings(text, at, breaks):
            code = SYMBOLS.get(c, OTHER)
            for (a, b, solid), (value, word) in paths.items():
                if c == " ":
                    key, step = (0, 0, solid), table[a][b][0] if b else 0.0
                else:
                    key, step = ((b, code, True), table[a][b][code]) if c else ((a, b, solid), 0.0)
                new = value + cost + step
                if key not in following or new > following[key][0]:
                    following[key] = (new, word + c)
        paths = following
    return "".join(settled) + max((value if not b and solid else value + table[a][b][0], word) for (a, b, solid), (value, word) in paths.items())[1]


class Restorer:
    """Lower-cased words of a text, disguised ones restored."""

    def __init__(self, model: CharModel):
        self.model, self.known = model, {}

    def meant(self, stretch: str) -> list[str]:
        found = self.known.get(stretch)
        if found is None:
            found = [restore(stretch, self.model)]
            if not stretch.isalnum():
                found += restore(stretch, self.model, breaks=True).split()
            if len(self.known) > 200_000:
                self.known.clear()
            if len(stretch) <= LONG_STRETCH:
                self.known[stretch] = found
        return found

    def words(self, text: str | None) -> set[str]:
        """Distinct words of the restored text, with those of the plain text."""
        text = (text or "").lower()
        out = set(WORDS.findall(text))
        at = 0
        while found := HINT.search(text, at):
            head = found.start()
            while head > at and not text[head - 1].isspace():
                head -= 1
            at = RUN.match(text, found.start()).end()
            out.update(self.meant(text[head:at].strip(EDGE)))
        for found in SPACED.finditer(text):
            out.update(self.meant(found[0]))
        for found in CHAINED.finditer(text):
            out.update(self.meant(found[0].replace(found[1], "")))
        out.discard("")
        return out


def signs_of(words: set[str]) -> set[str]:
    """Words, and beginnings of longer ones marked by a hyphen."""
    out = set(words)
    for n in BEGINNINGS:
        out.update(w[:n] + "-" for w in words if len(w) > n)
    return out


# Fitting


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the words of all documents: a table of fixed size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            words: Counter = Counter()
            for text in batch.column(0):
                words.update(WORDS.findall((text.as_py() or "").lower()))
            for word in [w for w in words if THRICE.search(w)]:
                del words[word]  # drawn out, not as spelled
            if words:
                times = np.fromiter(words.values(), np.int64, len(words))
                size = np.fromiter(map(len, words), np.int64, len(words))
                points = np.frombuffer("".join("^^" + w + "^" for w in words).encode("utf-32-le"), np.uint32)
                code = np.full(len(points), OTHER, np.int64)
                plain = points < 128
                lookup = np.full(128, OTHER, np.int64)
                for c, i in SYMBOLS.items():
                    lookup[ord(c)] = i
                code[plain] = lookup[points[plain]]
                grams = code[:-2] * SIZE * SIZE + code[1:-1] * SIZE + code[2:]
                of = np.repeat(times, size + 3)[:-2]
                inside = np.ones(len(grams), bool)
                ends = np.cumsum(size + 3)[:-1]
                inside[ends - 1], inside[ends - 2] = False, False
                total += np.bincount(grams[inside], weights=of[inside], minlength=SIZE**3).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SIZE**3)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out.reshape(SIZE, SIZE, SIZE)


def teaching_rows(labels: DataFrame, learnable: Column) -> DataFrame:
    """(doc_id, toxic) of at most about FIT_ROWS labelled documents that may teach; contradicting labels count as toxic."""
    rows = labels.filter(learnable & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = rows.count()
    space = 1 << 30
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < int(space * min(1.0, FIT_ROWS / max(n, 1))))


class Signs:
    """The learned signs with their precision, and what a document without any scores."""

    def __init__(self, precision: dict[str, float], rest: float):
        self.precision, self.rest = precision, rest
        self.heads = {sign[: min(BEGINNINGS)] for sign in precision}

    def score(self, words: set[str]) -> float:
        heads, least, wrong = self.heads, min(BEGINNINGS), 1.0
        for sign in signs_of({w for w in words if w[:least] in heads}) & self.precision.keys():
            wrong *= 1 - self.precision[sign]
        return 1 - wrong * (1 - self.rest)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, model: CharModel) -> Signs:
    """Learn signs from the labelled documents that ``learnable`` (over doc_id) admits.

    The labels sent to all tasks are bounded by FIT_ROWS; the driver receives the candidate signs of toxic documents.
    Without labels, or with labels of one kind, there are no signs and every score is the smoothed share of toxic.
    """
    taught = teaching_rows(labels, learnable)
    joined = docs.select("doc_id", "text").join(F.broadcast(taught), "doc_id").select("doc_id", F.col("toxic").cast("int"), F.col("text").cast("string"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            good, bad = Counter(), Counter()
            for toxic, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                signs = signs_of(restorer.words(text))
                signs.add("")  # counts documents
                (bad if toxic else good).update(signs)
            names = list(bad.keys() | good.keys())
            columns = [pa.array(names, pa.string()), pa.array([bad[s] for s in names], pa.int64()), pa.array([good[s] for s in names], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["sign", "bad", "good"])

    counts = joined.mapInArrow(run, "sign string, bad long, good long").groupBy("sign").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    useful = (F.col("sign") == "") | ((F.col("bad") >= MIN_DOCS) & (F.col("bad") >= MIN_PRECISION * (F.col("bad") + F.col("good"))))
    found = {r["sign"]: (r["bad"], r["good"]) for r in counts.filter(useful).orderBy(F.desc("bad"), "sign").limit(20 * MAX_SIGNS).collect()}
    all_bad, all_good = found.pop("", (0, 0))
    candidates = set(found)

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            lists = [sorted(signs_of(restorer.words(t)) & candidates) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["signs"])

    bad_rows = [set(r["signs"]) for r in joined.filter("toxic = 1").mapInArrow(of, "signs array<string>").collect()]
    chosen: dict[str, float] = {}
    weights, holders = [1.0] * len(bad_rows), {}
    for i, signs in enumerate(bad_rows):
        for sign in signs:
            holders.setdefault(sign, []).append(i)
    gain = {sign: float(len(rows)) for sign, rows in holders.items()}
    while gain and len(chosen) < MAX_SIGNS:
        sign = min(gain, key=lambda s: (-gain[s], s))
        if gain.pop(sign) < MIN_DOCS:
            break
        bad, good = found[sign]
        chosen[sign] = (bad + 0.5) / (bad + good + 1)
        for i in holders[sign]:
            lost = weights[i] * (1 - FADE)
            weights[i] -= lost
            for other in bad_rows[i]:
                if other in gain:
                    gain[other] -= lost
    covered = sum(1 for signs in bad_rows if signs & chosen.keys())
    rest = (all_bad - covered + 0.5) / (all_bad - covered + all_good + 1)
    return Signs(chosen, rest if chosen else (all_bad + 0.5) / (all_bad + all_good + 1))


def score_documents(docs: DataFrame, signs: Signs, model: CharModel) -> DataFrame:
    """doc_id and score of every row; null texts are empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            found = [signs.score(restorer.words(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether CRC-32 of the id as text is a multiple of ``folds``; rows without id are held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted for every row; labels of held-out documents are never read."""
    model = CharModel(character_counts(docs))
    signs = fit(docs, labels, ~held_out(F.col("doc_id"), folds), model)
    rows = score_documents(docs, signs, model)
    return rows.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
