"""Question-answer documents, chunking, prompts and dialogue state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import chunks, html_to_text, spread_sentences, word_count
from millrace.operators.running import TILE, running_totals
from millrace.session import scratch_path

# Turns of one conversation that one task handles together.
TURNS = 1_000


def quality_filter(df: DataFrame, score: str, body: str, min_score: int = 5, max_len: int = 1000) -> DataFrame:
    return df.filter((F.col(score) >= min_score) & (F.length(body) <= max_len))


def posts_to_text(posts: DataFrame, key: str, parent: str, body: str, score: str, min_score: int = 5, max_len: int = 1000) -> DataFrame:
    """Good, short posts as (id, parent_id, body), the markup taken out of the body; the columns are named by the caller."""
    text = html_to_text(F.col(body)).alias("body")
    return quality_filter(posts, score, body, min_score, max_len).select(F.col(key).alias("id"), F.col(parent).alias("parent_id"), text)


def qa_pairs(posts: DataFrame, id_: str = "id", parent: str = "parent_id", body: str = "body") -> DataFrame:
    """Every answer with its question: posts whose parent is a post without parent."""
    questions = posts.filter(F.col(parent).isNull()).select(F.col(id_).alias("_q"), F.col(body).alias("question"))
    answers = posts.select(F.col(id_).alias("answer_id"), F.col(parent).alias("_q"), F.col(body).alias("answer"))
    return questions.join(answers, "_q").select("answer_id", "question", "answer")


def qa_documents(pairs: DataFrame) -> DataFrame:
    """Question, blank line, answer; null if either is missing."""
    return pairs.select(
        F.col("answer_id").alias("source"), F.concat("question", F.lit("\n\n"), "answer").alias("text")
    )


def chunk_text(df: DataFrame, key: str, text: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    return df.select(key, F.posexplode(chunks(F.col(text), size, overlap)).alias("chunk", "chunk_text"))


def shorten(
    df: DataFrame,
    text: str,
    limit: int = 5000,
    target: int = 1000,
    hook: Callable[[Column], Column] | None = None,
    name: str = "text_short",
) -> DataFrame:
    """A shorter version of texts above ``limit``; others as they are.

    ``hook`` is a model as a column function, such as an iterator pandas_udf that loads its model
    once per task. Without it, sentences spread over the whole text make up about ``target`` characters.
    """
    col = F.col(text)
    summary = hook(col) if hook else spread_sentences(col, target)
    return df.withColumn(name, F.when(F.length(col) > limit, summary).otherwise(col))


def build_prompts(
    df: DataFrame,
    template: str,
    context: str,
    question: str,
    history: str | None = None,
    name: str = "prompt",
    separator: str = "\n\n",
) -> DataFrame:
    """Fill ``{context}``, ``{question}`` and ``{history}`` of a template; context is an array of texts."""
    slots = {
        "{context}": F.array_join(F.coalesce(F.col(context), F.array().cast("array<string>")), separator),
        "{question}": F.coalesce(F.col(question), F.lit("")),
        "{history}": F.coalesce(F.col(history), F.lit("")) if history else F.lit(""),
    }
    # Cut the template at its slots first, so that texts holding braces stay untouched.
    parts: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find(s), s) for s in slots if s in rest]
        if not hits:
            parts.append(F.lit(rest))
            break
        at, slot = min(hits)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(slots[slot])
        rest = rest[at + len(slot) :]
    return df.withColumn(name, F.concat(*parts))


def _turn_tile(df: DataFrame, turn: str, turns: int) -> Column:
    """Tile of a turn: so many numbers, or an hour where turns are told by time. Rows without turn have one of their own."""
    kind = dict(df.dtypes)[turn]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        tile = F.floor(F.unix_micros(F.col(turn).cast("timestamp")) / F.lit(3_600_000_000))
    else:
        tile = F.floor(F.col(turn) / F.lit(turns))
    return F.coalesce(tile.cast("long"), F.lit(-(2**62)).cast("long"))


def trim_history(df: DataFrame, conv: str, turn: str, text: str, budget: int = 500, turns: int = TURNS) -> DataFrame:
    """The newest turns of each conversation that together hold at most ``budget`` words.

    Words are summed by turn first, so a turn with many rows is one row of the running total; the total is taken by
    tiles of ``turns`` turns, so a long conversation is no single task's.
    """
    rows = df.withColumn("tokens", word_count(F.col(text)).cast("long"))
    by_turn = rows.groupBy(F.col(conv).alias("_conv"), F.col(turn).alias("_turn")).agg(F.sum("tokens").alias("_tokens"))
    by_turn = by_turn.withColumn(TILE, _turn_tile(by_turn, "_turn", turns))
    totals = running_totals(by_turn, ["_conv"], [F.desc("_turn")], {"tokens_from_end": "_tokens"}, tile_descending=True)
    kept = totals.filter(F.col("tokens_from_end") <= budget).select("_conv", "_turn", "tokens_from_end")
    same = F.col(conv).eqNullSafe(F.col("_conv")) & F.col(turn).eqNullSafe(F.col("_turn"))
    return rows.join(kept, same).select(*rows.columns, "tokens_from_end")


def dialogue_context(
    df: DataFrame,
    conv: str,
    turn: str,
    text: str,
    last: int = 3,
    separator: str = " \n",
    name: str = "context",
    turns: int = TURNS,
) -> DataFrame:
    """Each turn's text joined with the ``last`` - 1 before it in the conversation.

    Conversations are cut into tiles of ``turns`` turns; each tile starts with the few turns before it.
    """
    rows = df.select(conv, turn, F.col(text).alias("_text"))
    rows = rows.withColumn(TILE, _turn_tile(rows, turn, turns))
    newest = Window.partitionBy(conv, TILE).orderBy(F.desc(turn))
    tails = (
        rows.withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") < last)
        .groupBy(conv, TILE)
        .agg(F.sort_array(F.collect_list(F.struct(turn, "_text"))).alias("_tail"))
    )
    before = Window.partitionBy(conv).orderBy(TILE).rowsBetween(-(last - 1), -1)
    led = tails.withColumn("_lead", F.flatten(F.collect_list("_tail").over(before)))
    lead = led.select(conv, TILE, F.inline("_lead")).withColumn("_carry", F.lit(True))
    both = rows.withColumn("_carry", F.lit(False)).unionByName(lead)
    here = Window.partitionBy(conv, TILE).orderBy(turn).rowsBetween(-(last - 1), 0)
    return (
        both.withColumn(name, F.array_join(F.collect_list("_text").over(here), separator))
        .filter(~F.col("_carry"))
        .select(conv, turn, name)
    )


def _fold(turns: Column, state: Column, turn: str, last: int) -> Column:
    """Walk through sorted turns; keep what the last used sources do not hold."""

    def step(acc: Column, x: Column) -> Column:
        kept = F.filter(x["retrieved"], lambda s: ~F.array_contains(acc["state"], s))
        used = F.concat(acc["state"], kept)
        state_now = F.slice(used, F.greatest(F.lit(1), F.size(used) - last + 1), last)
        return F.struct(
            state_now.alias("state"),
            F.concat(acc["out"], F.array(F.struct(x[turn].alias(turn), kept.alias("kept")))).alias("out"),
        )

    kind = f"array<struct<{turn}:bigint,kept:array<string>>>"
    return F.aggregate(turns, F.struct(state.alias("state"), F.array().cast(kind).alias("out")), step)


def dedupe_recent_sources(df: DataFrame, conv: str, turn: str, retrieved: str, last: int = 3, turns: int = 200):
    """Per turn, the retrieved sources that are not among the ``last`` sources used so far.

    What counts as used depends on all earlier turns. Conversations are cut into pieces of ``turns`` rows: each piece
    first runs from an empty start; pieces whose true start, the end of the piece before, turns out different run
    again, until nothing changes. A conversation leaves as soon as it is settled, so short ones need one pass only.
    """
    rows = df.select(conv, F.col(turn).cast("long").alias(turn), F.col(retrieved).cast("array<string>").alias("retrieved"))
    tiled = rows.withColumn(TILE, _turn_tile(rows, turn, turns))
    placed = running_totals(tiled, [conv], [turn, "retrieved"], {"_at": F.lit(1)})
    pieces = (
        placed.withColumn("_piece", F.floor((F.col("_at") - 1) / turns))
        .groupBy(conv, "_piece")
        .agg(F.sort_array(F.collect_list(F.struct(turn, "retrieved"))).alias("_turns"))
    )
    empty = F.array().cast("array<string>")
    order = Window.partitionBy(conv).orderBy("_piece")
    left = pieces.withColumn("_start", empty).withColumn("_done", _fold(F.col("_turns"), F.col("_start"), turn, last))
    spark, out = df.sparkSession, []
    while True:
        path = scratch_path(spark, "sources")
        want = F.coalesce(F.lag("_done.state").over(order), empty)
        left.withColumn("_want", want).withColumn("_moved", F.max(F.col("_want") != F.col("_start")).over(Window.partitionBy(conv))).write.parquet(path)
        done = spark.read.parquet(path)
        out.append(done.filter(~F.col("_moved")).select(conv, F.inline("_done.out")))
        moved = done.filter("_moved")
        if moved.isEmpty():
            return reduce(lambda x, y: x.unionByName(y), out)
        again = _fold(F.col("_turns"), F.col("_want"), turn, last)
        fresh = F.when(F.col("_want") != F.col("_start"), again).otherwise(F.col("_done"))
        left = moved.select(conv, "_piece", "_turns", F.col("_want").alias("_start"), fresh.alias("_done"))


def flatten(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Fields of a struct column as columns next to the kept ones."""
    return df.select(*keep, f"{column}.*")
