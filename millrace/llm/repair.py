"""Conversation structure repair: a generalised LR parse of the roles with weighted deletions, new roles and insertions.

The parser reads a conversation from its last turn to its first. A node of its graph-structured stack is a stack top
before a turn; it holds the least (cost, audit) of all ways to finish from there, so equal tops merge. Read that way an
audit only grows at its front, and a smaller rest stays smaller whatever is put before it; read forwards, of two audits
one of which begins the other, the rest would still decide.

Long conversations are cut into blocks. Blocks give cost tables between stack tops, a scan over these tables gives each
block the costs of what follows it, then each block gives its way for every top it may be entered with, and a second scan
picks the entry. Neither scan sees a turn.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACES, written
from millrace.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Roles by initial: nothing, or a user and an assistant in turn with an assistant at the end, after one system turn or none.
GRAMMAR = {"Talk": ((), ("Open", "a")), "Open": (("u",), ("s", "u"), ("Open", "a", "u"))}
ROLES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1
NEVER = 1 << 60

#: Turns of a block, and how many characters of a text stand before its hash in the order of turns.
BLOCK, HEAD = 16_384, 64
MARK = r"[^\x20\x09-\x0D]"


def stack_tops(rules: dict, start: str, limit: int = 64) -> tuple[list[dict[str, int]], list[bool]]:
    """For each stack top of the LR automaton the top after shifting a role and reducing, and whether the input may end.

    Stacks are explored from the empty one, with all reductions; stacks that can neither shift nor end are dropped. A
    grammar with more than ``limit`` tops is refused.
    """

    def closure(items: set) -> frozenset:
        todo = list(items)
        while todo:
            _, right, dot = todo.pop()
            for option in rules.get(right[dot], ()) if dot < len(right) else ():
                item = (right[dot], option, 0)
                if item not in items:
                    items.add(item)
                    todo.append(item)
        return frozenset(items)

    def state(stack: tuple) -> frozenset:
        items = closure({(start, right, 0) for right in rules[start]})
        for symbol in stack:
            items = closure({(left, right, dot + 1) for left, right, dot in items if dot < len(right) and right[dot] == symbol})
        return items

    def reduced(stacks: set) -> frozenset:
        todo, seen = list(stacks), set(stacks)
        while todo:
            stack = todo.pop()
            for left, right, dot in state(stack):
                if dot == len(right) and right and left != start:
                    shorter = (*stack[: len(stack) - len(right)], left)
                    if shorter not in seen and state(shorter):
                        seen.add(shorter)
                        todo.append(shorter)
        alive = {s for s in seen if any((d < len(r) and r[d] not in rules) or (d == len(r) and le == start) for le, r, d in state(s))}
        return frozenset(alive)

    tops, moves, ends = [reduced({()})], [], []
    for at in range(limit + 1):
        if at == len(tops):
            return moves, ends
        going: dict[str, set] = {}
        for stack in tops[at]:
            for _, right, dot in state(stack):
                if dot < len(right) and right[dot] not in rules:
                    going.setdefault(right[dot], set()).add((*stack, right[dot]))
        move = {}
        for symbol in sorted(going):
            top = reduced(going[symbol])
            if top not in tops:
                tops.append(top)
            move[symbol] = tops.index(top)
        moves.append(move)
        ends.append(any(d == len(r) and le == start for s in tops[at] for le, r, d in state(s)))
    raise ValueError(f"the grammar has more than {limit} stack tops")


class Parser:
    """The edit graph over one block. A turn's kind is its role initial, with ``!`` if cut short, or ``-`` if it has to go."""

    def __init__(self, rules: dict = GRAMMAR, start: str = "Talk"):
        self.moves, self.ends = stack_tops(rules, start)
        self.tops = range(len(self.moves))
        # the only role that may be put at a top: were there two, one letter of an audit would stand for two ways
        self.put: list[str | None] = []
        for move in self.moves:
            roles = [r for r in ROLES if r in move]
            if len(roles) > 1:
                raise ValueError("a stack top takes two of the roles that can be inserted")
            self.put.append(roles[0] if roles else None)
        self.memo: dict = {}

    def _inserted(self, costs: list[int], letters: list[str]) -> tuple[tuple, tuple]:
        """With insertions where they are cheaper, or as cheap and first in the order of letters."""
        for _ in self.tops:
            for q in self.tops:
                if self.put[q] is not None:
                    way = INSERT + costs[self.moves[q][self.put[q]]]
                    if way < costs[q] or (way == costs[q] < NEVER and letters[q] > "I"):
                        costs[q], letters[q] = way, "I"
        return tuple(min(c, NEVER) for c in costs), tuple(letters)

    def end(self) -> tuple[tuple, tuple]:
        """Costs and first letters of finishing where no turn is left."""
        return self._inserted([0 if e else NEVER for e in self.ends], ["" if e else "~" for e in self.ends])

    def before(self, after: tuple, kind: str) -> tuple[tuple, tuple]:
        """Costs and first letters at each top before a turn, from the costs behind it."""
        costs, letters = [], []
        more = CUT if kind.endswith("!") else 0
        for q in self.tops:
            ways = [(DELETE + after[q], "D")]
            if kind != "-":
                move = self.moves[q]
                if kind[0] in move:
                    ways.append((more + after[move[kind[0]]], "K"))
                if self.put[q] is not None:
                    ways.append((more + REROLE + after[move[self.put[q]]], "R"))
            cost, letter = min(ways)
            costs.append(cost)
            letters.append(letter)
        return self._inserted(costs, letters)

    def choices(self, kinds: list[str], counts: list[int], after: tuple) -> tuple[list[tuple], tuple]:
        """For each run of equal turns (only ``-`` runs are longer than one) the first letter at each top; costs before the block.

        Costs differ by little between tops, so there are few distinct steps; they are kept, less their least cost.
        """
        out = [()] * len(kinds)
        base = min(after)
        costs = tuple(c - base if c < NEVER else NEVER for c in after)
        for at in range(len(kinds) - 1, -1, -1):
            step = self.memo.get((costs, kinds[at]))
            if step is None:
                found, letters = self.before(costs, kinds[at])
                least = min(found)
                step = self.memo[costs, kinds[at]] = tuple(c - least if c < NEVER else NEVER for c in found), letters, least
            # a longer run costs as much again: costs behind it already allow for insertions
            costs, out[at], least = step
            base += least + DELETE * (counts[at] - 1)
        return out, tuple(c + base if c < NEVER else NEVER for c in costs)

    def between(self, kinds: list[str], counts: list[int]) -> list[int]:
        """Least costs from each top to each top over the block, row by row."""
        ends = []
        for q in self.tops:
            target = [NEVER] * len(self.moves)
            target[q] = 0
            ends.append(self.choices(kinds, counts, tuple(target))[1])
        return [ends[q][p] for p in self.tops for q in self.tops]

    def walk(self, kinds: list[str], counts: list[int], letters: list[tuple], top: int, last: tuple | None) -> tuple[list[str], list[tuple], int]:
        """Audit pieces, kept or inserted turns (index of the run or None, letter, role put) and the top reached.

        ``last`` are the letters behind the conversation's last turn; None if other blocks follow.
        """
        audit, kept = [], []

        def put(q: int, at: int | None, letter: str) -> int:
            audit.append(letter)
            kept.append((at, letter, ROLES[self.put[q]]))
            return self.moves[q][self.put[q]]

        for at, kind in enumerate(kinds):
            while letters[at][top] == "I":
                top = put(top, None, "I")
            letter = letters[at][top]
            if letter == "D":
                audit.append("D" * counts[at])
            elif letter == "K":
                audit.append("K")
                kept.append((at, "K", None))
                top = self.moves[top][kind[0]]
            else:
                top = put(top, at, "R")
        while last is not None and last[top] == "I":
            top = put(top, None, "I")
        return audit, kept, top


# Turns in order


def faults(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``n`` copies and what is wrong: blank, first (of its role and text) and cut, all by hashes of texts.

    Nulls in role and text are one space. Equal rows combine before they move; a text repeated through a conversation is
    one row a turn, and its first turn comes from one aggregate.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    last = F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1)
    small = turns.select(
        "conv_id", "turn", role.alias("role"), F.substring(text, 1, HEAD).alias("head"), F.unhex(F.sha2(text, 256)).alias("code"),
        (~text.rlike(MARK)).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    rows = written(small.groupBy(*small.columns).agg(F.count("*").alias("n")), "repair-turns")
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    again = rows.filter(~F.col("blank")).groupBy("conv_id", "role", "code").agg(F.min(place).alias("at"), F.count("*").alias("turns"))
    again = again.filter("turns > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("code").alias("k"), F.col("at.turn").alias("first_turn"), F.lit(True).alias("again"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("code") == F.col("k"))
    marked = rows.join(again, same, "left").withColumn("first", F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn")))
    return written(marked.select(*rows.columns, "first"), "repair-faults")


LEGAL = {"su", "ua", "au"}
BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("open", pa.bool_()),
    ("begins", pa.string()), ("stops", pa.string()), ("illegal", pa.int64()),
    ("kinds", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("codes", pa.list_(pa.binary())),
])
BLOCKS_SQL = (
    "conv_id long, part int, seq int, open boolean, begins string, stops string, illegal long,"
    "kinds array<string>, counts array<long>, turns array<long>, roles array<string>, codes array<binary>"
)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 16_384) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of about so many rows, or entries of the last column's lists."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

    ready, held = [], 0
    for row in rows:
        ready.append(row)
        held += len(row[-1]) if isinstance(row[-1], list) else 1
        if held >= size or len(ready) >= size:
            yield batch()
            ready, held = [], 0
    if ready:
        yield batch()


def tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _block(part: int, seq: int, is_open: bool, rows: list[tuple]) -> tuple:
    """One block of (conv_id, turn, role, code, n, blank, cut, first) rows in their order."""
    illegal, before, runs = 0, None, []
    for _, turn, role, code, n, blank, cut, first in rows:
        initial = role[:1]
        illegal += n - 1 + (before is not None and before + initial not in LEGAL)
        before = initial
        keep = not blank and first
        if keep:
            runs.append(((initial if initial in ("s", "u", "a") else "?") + "!" * cut, 1, turn, role, code))
        if n > keep:
            runs.append(("-", n - keep, turn, role, code))
    return rows[0][0], part, seq, is_open, rows[0][2][:1], before, illegal, *(list(c) for c in zip(*runs))


def _blocks(part: int, rows: Iterable[tuple], size: int) -> Iterator[tuple]:
    """Blocks of one task's sorted rows. Only a conversation that begins and ends here and fits one block is not open."""
    seq, held, touched = 0, [], True  # touched: the conversation at hand may have rows elsewhere
    for row in rows:
        if held and row[0] != held[0][0]:
            yield _block(part, seq, touched, held)
            seq, held, touched = seq + 1, [], False
        elif len(held) == size:
            yield _block(part, seq, True, held)
            seq, held, touched = seq + 1, [], True
        held.append(row)
    if held:
        yield _block(part, seq, True, held)


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Runs of turns in order of turn (nulls first), role, beginning and hash of the text, cut into blocks.

    A range shuffle splits conversations of any length. Kinds, counts, turns, roles and codes of the runs go in parallel
    lists of at most twice ``size`` entries; ``begins`` and ``stops`` are the first and last role initial.
    """
    order = ["conv_id", "turn", "role", "head", "code"]
    sorts = [F.col(c).asc_nulls_first() for c in order]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_blocks(TaskContext.get().partitionId(), tuples(batches), size), BLOCKS)

    dealt = rows.repartitionByRange(parallelism(rows.sparkSession), *sorts).sortWithinPartitions(*sorts)
    return dealt.select("conv_id", "turn", "role", "code", "n", "blank", "cut", "first").mapInArrow(run, BLOCKS_SQL)


# Solving blocks

SOLVED = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("audit", pa.string()), ("cost", pa.int64()),
    ("places", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())), ("turns", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())), ("codes", pa.list_(pa.binary())), ("put", pa.list_(pa.string())),
])
SOLVED_SQL = (
    "conv_id long, part int, seq int, audit string, cost long, places array<long>, edits array<string>, turns array<long>,"
    "roles array<string>, codes array<binary>, put array<string>"
)


def _solved(parser: Parser, row: dict, after: tuple, top: int, offset: int, last: tuple | None) -> tuple:
    """One block with its audit, cost and the turns that stay, from the costs behind it and the top and place it starts with."""
    letters, _ = parser.choices(row["kinds"], row["counts"], after)
    audit, kept, _ = parser.walk(row["kinds"], row["counts"], letters, top, last)
    audit = "".join(audit)
    cost = audit.count("D") * DELETE + audit.count("R") * REROLE + audit.count("I") * INSERT
    cost += CUT * sum(at is not None and row["kinds"][at].endswith("!") for at, _, _ in kept)

    def of(name: str) -> list:
        return [None if at is None else row[name][at] for at, _, _ in kept]

    return (
        row["conv_id"], row["part"], row["seq"], audit, cost, list(range(offset, offset + len(kept))), [e for _, e, _ in kept],
        of("turns"), of("roles"), of("codes"), [p for _, _, p in kept],
    )


def _each(df: DataFrame, columns: list[str], make, schema: pa.Schema, sql: str) -> DataFrame:
    """``make(parser, row)`` for every row, as tuples of ``schema``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        yield from batched((make(parser, dict(zip(columns, row))) for row in tuples(batches)), schema)

    return df.select(*columns).mapInArrow(run, sql)


def _scan(df: DataFrame, make, sql: str) -> DataFrame:
    """``make(parser, rows)`` for the blocks of each conversation in order; a few numbers a block, never turns."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        return pa.Table.from_pylist(make(Parser(), rows))

    return df.groupBy("conv_id").applyInArrow(run, sql)


def _right_costs(parser: Parser, rows: list[dict]) -> list[dict]:
    """Costs behind each block from the cost tables of those after it."""
    after, _ = parser.end()
    n, out = len(parser.tops), []
    for i, row in enumerate(reversed(rows)):
        out.append({"part": row["part"], "seq": row["seq"], "final": i == 0, "after": list(after)})
        table = row["table"]
        after = tuple(min(min(table[p * n + q] + after[q] for q in parser.tops), NEVER) for p in parser.tops)
    return out


def _entries(parser: Parser, rows: list[dict]) -> list[dict]:
    """The top each block is entered with and how many turns stay before it."""
    top, offset, before, out = 0, 0, None, []
    for row in rows:
        bad = before is not None and before + row["begins"] not in LEGAL
        out.append({"part": row["part"], "seq": row["seq"], "top": top, "place": offset, "joint": int(bad)})
        offset += row["kept"][top]
        top, before = row["tops"][top], row["stops"]
    return out


def solved(packed: DataFrame) -> DataFrame:
    """Audit, cost and turns that stay for every block of ``blocks`` (as a written table), with the illegal pairs between blocks."""
    names = BLOCKS.names
    where = ["part", "seq"]

    def alone(parser: Parser, row: dict) -> tuple:
        after, last = parser.end()
        return _solved(parser, row, after, 0, 0, last)

    def tabled(parser: Parser, row: dict) -> tuple:
        return row["conv_id"], row["part"], row["seq"], parser.between(row["kinds"], row["counts"])

    def mapped(parser: Parser, row: dict) -> tuple:
        letters, _ = parser.choices(row["kinds"], row["counts"], tuple(row["after"]))
        ways = [parser.walk(row["kinds"], row["counts"], letters, q, None) for q in parser.tops]
        return row["conv_id"], row["part"], row["seq"], row["begins"], row["stops"], [w[2] for w in ways], [len(w[1]) for w in ways]

    def placed(parser: Parser, row: dict) -> tuple:
        return _solved(parser, row, tuple(row["after"]), row["top"], row["place"], parser.end()[1] if row["final"] else None)

    whole = _each(packed.filter(~F.col("open")), names, alone, SOLVED, SOLVED_SQL).withColumn("joint", F.lit(0))
    split = packed.filter("open")
    key = [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32())]
    tables = _each(split, names, tabled, pa.schema([*key, ("table", pa.list_(pa.int64()))]), "conv_id long, part int, seq int, table array<long>")
    behind = written(_scan(tables, _right_costs, "part long, seq long, final boolean, after array<long>"), "repair-behind")
    costed = split.join(behind, where)
    maps = _each(
        costed, [*names, "after"], mapped,
        pa.schema([*key, ("begins", pa.string()), ("stops", pa.string()), ("tops", pa.list_(pa.int32())), ("kept", pa.list_(pa.int64()))]),
        "conv_id long, part int, seq int, begins string, stops string, tops array<int>, kept array<long>",
    )
    entries = written(_scan(maps, _entries, "part long, seq long, top long, place long, joint long"), "repair-entries")
    more = ["after", "final", "top", "place"]
    open_ = _each(costed.join(entries, where), [*names, *more], placed, SOLVED, SOLVED_SQL)
    open_ = open_.join(entries.select(*where, "joint"), where).select(*SOLVED.names, "joint")
    return written(whole.unionByName(open_), "repair-solved")


# What comes out


def _same(*pairs: tuple[str, str]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out &= F.col(a).eqNullSafe(F.col(b))
    return out


def repaired_turns(turns: DataFrame, done: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns that stay, with new roles, and those put in, in their places from 0.

    Texts meet the edits by hash; of equal rows one text moves.
    """
    kept = done.select("conv_id", F.explode(F.arrays_zip("places", "edits", "turns", "roles", "codes", "put")).alias("k")).select("conv_id", "k.*")
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    texts = turns.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), role.alias("r"), F.unhex(F.sha2(text, 256)).alias("h"), text.alias("text"))
    texts = texts.groupBy("c", "t", "r", "h").agg(F.min("text").alias("text"))
    found = kept.filter("edits <> 'I'").join(texts, _same(("conv_id", "c"), ("turns", "t"), ("roles", "r"), ("codes", "h")))
    put_in = kept.filter("edits = 'I'").withColumn("text", F.lit(""))
    columns = ["conv_id", F.col("places").alias("place"), F.col("edits").alias("edit"), F.coalesce("put", "roles").alias("role"), "text"]
    return found.select(*columns).unionByName(put_in.select(*columns))


def digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of (conv_id, place, line): lines joined by newlines, hashed as they stream by in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, sha = None, None
            for at, line in tuples(batches):
                if sha is not None and at == conv:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        yield conv, sha.hexdigest()
                    conv, sha = at, hashlib.sha256()
                sha.update(line.encode())
            if sha is not None:
                yield conv, sha.hexdigest()

        yield from batched(rows(), pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.select("conv_id", "line").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Conversations brought into ``GRAMMAR`` at least cost: (report, repaired turns) of (conv_id, turn, role, text).

    The report has a row for each conv_id (null is one too): gaps, blank, duplicate, truncated, illegal, cost and audit. A
    turn is blank, else a duplicate of an earlier role and text, else truncated. Turns stand in order of turn (nulls
    first), role, first 64 characters and hash of the text; equal rows follow one another. Nulls in role and text
    are one space; other columns are left out. Empty tables give empty results. ``size`` is the length of a block.
    """
    marked = faults(turns.select("conv_id", "turn", "role", "text"))
    count = F.col("n").cast("long")
    stay = F.when(F.col("first"), count - 1).otherwise(count)
    stats = marked.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), count).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), stay).otherwise(0)).alias("duplicate"),
        F.sum((~F.col("blank") & F.col("first") & F.col("cut")).cast("long")).alias("truncated"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
    )
    packed = written(blocks(marked, size), "repair-blocks")
    done = solved(packed)
    ways = done.join(packed.select("part", "seq", "illegal"), ["part", "seq"]).groupBy("conv_id").agg(
        F.sum("cost").alias("cost"),
        F.sum(F.col("illegal") + F.col("joint")).alias("illegal"),
        F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))).alias("parts"),
    )  # a few pieces a conversation; the audit is one string of a letter a turn
    ways = ways.select("conv_id", "cost", "illegal", F.array_join(F.col("parts.audit"), "").alias("audit"))
    both = stats.unionByName(ways, allowMissingColumns=True).groupBy("conv_id")
    report = both.agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")])
    return report, repaired_turns(turns, done)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows harmed by crc32 of ``conv_id:turn`` modulo 20, nulls being one space throughout."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    text = F.coalesce("text", F.lit(" "))
    harm = F.col("harm")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("harm"))
    rows = rows.filter(harm != 0).withColumns({
        "role": F.when(harm == 4, "user").otherwise(F.col("role")),
        "text": F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "copy": F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    })
    return rows.select("conv_id", "turn", "role", "text")


def structure_report(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Every conv_id of the turns with the faults, least edits and hash of its damaged and repaired conversation."""
    report, fixed = repair(damaged(turns), size)
    hashes = digests(fixed.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line")))
    every = turns.select("conv_id").distinct()
    rows = every.unionByName(report, allowMissingColumns=True).unionByName(hashes, allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The query over ``conversations`` in another engine: the edit costs turn by turn from the last one on."""

    def add(key: str, cost: str, letter: str) -> str:
        return f"(lpad((left({key}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || '{letter}' || substr({key}, 13))"

    never = "lpad('', 12, '9')"
    moves = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    ways = []
    for q, move in enumerate(moves):
        keep = " ".join(f"WHEN initial = '{r}' THEN {add(f'k{to}', 'cut', 'K')}" for r, to in move.items())
        put = next(to for r, to in move.items() if r != "s")
        alive = f"CASE WHEN gone THEN {never} ELSE least(CASE {keep} ELSE {never} END, {add(f'k{put}', '(2 + cut)', 'R')}) END"
        ways.append(f"least({add(f'k{q}', '3', 'D')}, {alive}) AS b{q}")
    return f"""
WITH RECURSIVE names AS (
  SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
crc AS (
  SELECT name, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: ascii(name[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS harm
  FROM names),
rows0 AS (
  SELECT conv_id, turn, harm, CASE WHEN harm = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM conversations JOIN crc ON name = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')),
rows1 AS (SELECT conv_id, turn, role, text FROM rows0, range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) c),
t AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM rows1 WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, {HEAD}), sha256(text))),
u AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND seen AS again,
         CASE WHEN trimmed <> '' AND NOT seen AND right(trimmed, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM t)),
steps AS (
  SELECT conv_id, n + 1 AS i, '000000000000' AS k0, '000000000004II' AS k1, '000000000002I' AS k2, '000000000000' AS k3
  FROM (SELECT DISTINCT conv_id, n FROM u)
  UNION ALL
  SELECT conv_id, i, least(b0, {add('e2', '2', 'I')}), least(b1, {add('e2', '2', 'I')}), e2, e3 FROM (
    SELECT *, least(b2, {add('b3', '2', 'I')}) AS e2, least(b3, {add('b2', '2', 'I')}) AS e3 FROM (
      SELECT s.conv_id, r.i, {', '.join(ways)}
      FROM steps s JOIN (SELECT *, blank OR again AS gone FROM u) r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i - 1))),
found AS (SELECT conv_id, left(k0, 12)::BIGINT AS cost, substr(k0, 13) AS audit FROM steps WHERE i = 1),
edits AS (
  SELECT conv_id, j, audit[j] AS edit, length(regexp_replace(left(audit, j), 'I', '', 'g')) AS i,
         length(regexp_replace(left(audit, j), 'D', '', 'g')) AS place
  FROM found, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS j)),
kept AS (
  SELECT e.*, u.role, u.text, u.initial,
         bool_or(edit = 'K' AND place = 1 AND initial = 's') OVER (PARTITION BY e.conv_id) AS headed
  FROM edits e LEFT JOIN u ON e.edit <> 'I' AND e.conv_id IS NOT DISTINCT FROM u.conv_id AND e.i = u.i WHERE edit <> 'D'),
lines AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN headed THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS sha
  FROM kept GROUP BY conv_id),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM u GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id"""


SQL = _sql()
