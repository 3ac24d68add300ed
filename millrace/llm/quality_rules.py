"""Quality rules as a learned decision list: text statistics, sequential covering, ordered conditions.

Everything runs as DataFrame operations. Rules are grown and pruned from counts of labelled rows by
(feature, bin); the driver receives those counts only, at most ``len(FEATURES) * (BINS + 1)`` rows a step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, fresh, let, whole, written

#: Thresholds tried for a feature, at most.
BINS = 32
SYMBOLS = "[#*$%&|<>]"


def _repeated_words(words: Column) -> Column:
    """Words in five-word windows that occur twice or more."""
    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(rows: Column) -> Column:
            def twice(row: Column, at: Column) -> Column:
                before, after = F.get(rows, at - 1)["h"], F.get(rows, at + 1)["h"]
                return F.coalesce(before == row["h"], F.lit(False)) | F.coalesce(after == row["h"], F.lit(False))

            starts = F.array_sort(F.transform(F.filter(rows, twice), lambda r: r["i"]))
            zero = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))

            def add(state: Column, at: Column) -> Column:
                return F.struct(at.alias("last"), (state["n"] + F.least(F.lit(5), at - state["last"])).alias("n"))

            return F.aggregate(starts, zero, add, lambda s: s["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(placed, same))

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(5)])

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 5), window)
    return F.when(F.size(words) < 6, F.lit(0)).otherwise(let(windows, covered))


def statistics(text: str | Column = "text") -> Column:
    """A struct of counts of the whole text; a null text counts as empty."""
    body = whole(text)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))

    def count(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)).cast("long")

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(kept: Column) -> Column:
        n = F.size(kept)
        return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"))

    words = let(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), of_words)
    by_line = let(lines, of_lines)
    return F.struct(
        words.alias("w"),
        by_line.alias("l"),
        F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(r"\p{Lu}").alias("n_upper"),
        count(r"\p{Nd}").alias("n_digits"),
        count(r"[!?]").alias("n_marks"),
    )


def flat(stats: str) -> list[Column]:
    """The counts of ``statistics`` as columns."""
    s = F.col(stats)
    names = ("word_chars", "n_symbols", "n_upper", "n_digits", "n_marks")
    return [
        s["w"]["n_words"].alias("n_words"),
        s["w"]["n_repeat_words"].alias("n_repeat_words"),
        s["l"]["n_lines"].alias("n_lines"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"),
        *[s[n].alias(n) for n in names],
    ]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Too short, or more than a fifth of the words in repeated windows."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def _per(part: str, of: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))


#: What a condition may test, in the order that settles ties.
FEATURES = {
    "symbols_per_word": lambda: _per("n_symbols", "n_words"),
    "upper_share": lambda: _per("n_upper", "word_chars"),
    "digit_share": lambda: _per("n_digits", "word_chars"),
    "marks_per_word": lambda: _per("n_marks", "n_words"),
    "repeat_share": lambda: _per("n_repeat_words", "n_words"),
    "dup_line_share": lambda: _per("n_dup_lines", "n_lines"),
    "chars_per_word": lambda: _per("word_chars", "n_words"),
    "words_per_line": lambda: _per("n_words", "n_lines"),
    "words": lambda: F.col("n_words").cast("double"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def fired(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does. Reads the columns of ``flat``."""
    out = F.lit(0)
    for i in range(len(rules), 0, -1):
        out = F.when(_all([c.column() for c in rules[i - 1]]), F.lit(i)).otherwise(out)
    return out


def learn(
    labelled: DataFrame,
    reject: str = "reject",
    key: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.95,
    min_support: int = 10,
) -> list[Rule]:
    """Learn rules that reject, from rows with the columns of ``flat`` and a 0/1 column ``reject``.

    Two thirds of the rows (by hash of ``key``) grow rules by information gain, one third prunes them. A rule that
    stays under ``min_precision`` or ``min_support`` ends the list, so without rejected rows there are no rules.
    Rows without label are left out; equal gains go to the earlier feature and the lower threshold.
    """
    names = list(FEATURES)
    rows = labelled.filter(F.col(reject).isNotNull()).select(
        *[FEATURES[n]().alias(n) for n in names],
        (F.col(reject) == 1).alias("bad"),
        (F.pmod(F.xxhash64(F.lit("prune"), F.col(key)), F.lit(3)) == 0).alias("prune"),
    )
    rows = written(rows, "quality-labelled")
    probs = [i / BINS for i in range(BINS)]
    bad = F.when(F.col("bad"), 1)
    spread = rows.agg(*[F.percentile_approx(F.when(w, F.col(n)), probs, 2000).alias(f"{n}_{k}") for n in names for k, w in ((0, F.col("bad")), (1, ~F.col("bad")))]).first()
    cuts = {}
    for n in names:
        values = sorted({*(spread[f"{n}_0"] or []), *(spread[f"{n}_1"] or [])})
        if len(values) > BINS + 1:
            values = [values[round(i * (len(values) - 1) / BINS)] for i in range(BINS + 1)]
        cuts[n] = sorted({(a + b) / 2 for a, b in zip(values, values[1:])})
    # bin b: above the first b thresholds; value > cuts[j] is bin > j
    binned = [_bin(n, cuts[n]) for n in names]
    table = written(rows.select(*binned, "bad", "prune").groupBy(*names, "bad", "prune").agg(F.count("*").alias("n")), "quality-bins")

    def holds(feature: str, above: bool, j: int) -> Column:
        return F.col(feature) > j if above else F.col(feature) <= j

    rules: list[Rule] = []
    left = table
    while len(rules) < max_rules:
        grown: list[tuple[str, bool, int]] = []
        while len(grown) < max_conditions:
            sub = left.filter(~F.col("prune")).filter(_all([holds(*g) for g in grown]))
            long = sub.select(F.posexplode(F.array(*names)).alias("f", "bin"), "n", "bad")
            found = long.groupBy("f", "bin").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("all")).collect()
            best = _best(found, names, cuts)
            if best is None:
                break
            grown.append(best)
        if not grown:
            break
        prefix = [_all([holds(*g) for g in grown[:k]]) for k in range(1, len(grown) + 1)]
        sums = []
        for k, c in enumerate(prefix):
            for fold, w in (("g", ~F.col("prune")), ("p", F.col("prune"))):
                sums.append(F.sum(F.when(c & w & F.col("bad"), F.col("n"))).alias(f"{fold}p{k}"))
                sums.append(F.sum(F.when(c & w, F.col("n"))).alias(f"{fold}n{k}"))
        got = left.agg(*sums).first()

        def worth(k: int) -> float:
            p, n = got[f"pp{k}"] or 0, got[f"pn{k}"] or 0
            return (2 * p - n) / n if n else -1.0

        k = max(range(len(grown)), key=lambda i: (worth(i), -i))
        p = (got[f"pp{k}"] or 0) + (got[f"gp{k}"] or 0)
        n = (got[f"pn{k}"] or 0) + (got[f"gn{k}"] or 0)
        held_p, held_n = got[f"pp{k}"] or 0, got[f"pn{k}"] or 0
        if p < min_support or p < min_precision * n or held_p < min_precision * held_n:
            break
        rules.append(tuple(Condition(f, above, float(cuts[f][j])) for f, above, j in grown[: k + 1]))
        left = left.filter(~prefix[k])
    return rules


def _bin(name: str, thresholds: list[float]) -> Column:
    """How many of the thresholds the value exceeds."""
    if not thresholds:
        return F.lit(0).alias(name)
    value = F.col(name)
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in thresholds]), lambda x: value > x)).alias(name)


def _best(found: list, names: list[str], cuts: dict) -> tuple[str, bool, int] | None:
    """The condition with the highest gain, from counts by feature and bin."""
    from math import log2

    counts = {(r["f"], r["bin"]): (r["p"], r["all"]) for r in found}
    total_p = sum(p for (f, _), (p, _) in counts.items() if f == 0)
    total = sum(a for (f, _), (_, a) in counts.items() if f == 0)
    if not total_p or total_p == total:
        return None
    best, gain = None, 1e-9
    for f, name in enumerate(names):
        p = a = 0
        for j in range(len(cuts[name])):
            more_p, more = counts.get((f, j), (0, 0))
            p, a = p + more_p, a + more
            for above, pos, n in ((True, total_p - p, total - a), (False, p, a)):
                if pos:
                    g = pos * (log2(pos / n) - log2(total_p / total))
                    if g > gain + 1e-9:
                        best, gain = (name, above, j), g
    return best


def labels_of(labels: DataFrame) -> DataFrame:
    """One row per document: reject = 1 if every label says quality 0, else 0; null labels are left out."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg((F.max("quality") == 0).cast("int").alias("reject"))


def judged(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add base_failed, rule (number of the first rule that holds, else 0) and kept."""
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return counts.withColumns({"base_failed": failed, "rule": fired(rules)}).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def count_all(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every document, written once."""
    return docs.select("doc_id", statistics("text").alias("_s")).select("doc_id", *flat("_s"))


def learn_from(counts: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for documents that the base thresholds pass."""
    rows = counts.join(labels_of(labels), "doc_id").filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return learn(rows)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict for every document; the texts are read once."""
    counts = written(count_all(docs), "quality-counts")
    return judged(counts, learn_from(counts, labels))


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. Rows are judged one by one, so repeated rows stay repeated.

    Texts are counted twice, to learn and to judge, and never shuffled.
    """
    rules = learn_from(written(count_all(docs), "quality-counts"), labels)
    name, inner = fresh(docs, "_stats", "_rows")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(inner)
    stats = docs.select(row, statistics(F.col("text")).alias(name))
    return judged(stats.select(inner, *flat(name)), rules).filter("kept").select(f"{inner}.*")
