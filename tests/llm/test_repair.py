import hashlib
import itertools
import random
import re
import zlib

import pytest

from millrace.llm import repair as P

SCHEMA = "conv_id long, turn long, role string, text string, cost string, place long"
MARK = re.compile(r"[^\x20\x09-\x0D]")


def harmed(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode(), hashlib.sha256(r[3].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        marks = MARK.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def fits(out):
    rest = out[1:] if out[:1] == ["s"] else out
    return not out or (len(rest) >= 2 and len(rest) % 2 == 0 and all(x in ("*", "ua"[i % 2]) for i, x in enumerate(rest)))


def every_audit(rows):
    """Cheapest audit among all strings of edits with up to four insertions."""
    what, best = faults(rows), None
    for letters in itertools.product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and x != "D" for f, x in zip(what, letters)):
            continue
        for more in range(5):
            for at in itertools.combinations(range(len(rows) + more), more):
                rest, out, audit, cost = iter(zip(rows, letters, what)), [], "", 0
                for place in range(len(rows) + more):
                    if place in at:
                        audit, cost = audit + "I", cost + 2
                        out.append("*")
                        continue
                    row, letter, fault = next(rest)
                    audit += letter
                    cost += {"D": 3, "K": 0, "R": 2}[letter] + (letter != "D" and fault == "truncated")
                    out += [] if letter == "D" else ["*"] if letter == "R" else [row[2][:1]]
                if (best is None or (cost, audit) < best) and fits(out):
                    best = (cost, audit)
    return best


def backwards(rows):
    """Least (cost, audit) by stack top from the last turn on, in plain Python."""
    moves = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]

    def closed(best):
        for _ in range(4):
            for q, to in ((0, 2), (1, 2), (2, 3), (3, 2)):
                best[q] = min(best[q], (best[to][0] + 2, "I" + best[to][1]))
        return best

    far = (10**9, "")
    best = closed([(0, ""), far, far, (0, "")])
    for row, fault in zip(reversed(rows), reversed(faults(rows))):
        cut, after = fault == "truncated", []
        for q, move in enumerate(moves):
            ways = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                if row[2][:1] in move:
                    c, a = best[move[row[2][:1]]]
                    ways.append((c + cut, "K" + a))
                c, a = best[next(to for r, to in move.items() if r != "s")]
                ways.append((c + cut + 2, "R" + a))
            after.append(min(ways))
        best = closed(after)
    return best[0]


def report(table, found):
    out = {}
    for conv in {r[0] for r in table}:
        rows = ordered([r for r in harmed(table) if r[0] == conv])
        what = faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = found(rows)
        fixed, at, expected = [], 0, None
        for letter in audit:
            row = rows[at] if letter != "I" else None
            at += letter != "I"
            if letter == "D":
                continue
            role = row[2] if letter == "K" else "user" if expected in (None, "user") else "assistant"
            fixed.append(f"{role}:{row[3] if row else ''}")
            expected = "user" if role[0] == "s" or role[0] == "a" else "assistant"
        out[conv] = (gaps, *(what.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return out


def talks(n, longest, seed):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choices(["user", "assistant", "system", "tool", None, ""], [6, 6, 2, 1, 1, 1])[0]
            text = rnd.choice(["Hello.", "Why?", "It is so!", "It is so", "", " \t", None, "é.", "x" * 80 + rnd.choice("ab") + "."])
            rows.append((conv if conv else None, rnd.choice([turn, turn, turn, turn + 3, None]), role, text, "x", 7))
        if conv % 5 == 0:
            rows += rows[-1:] * 2
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def got(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in names) for r in rows}


def test_tops_are_those_of_the_grammar():
    assert P.stack_tops(P.GRAMMAR, "Talk") == ([{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}], [True, False, False, True])
    with pytest.raises(ValueError):  # nested talks have stacks without end
        P.stack_tops({"Talk": (("u", "Talk", "a"), ("u", "a"))}, "Talk")


def test_plain_backward_form_equals_all_audits():
    rnd = random.Random(3)
    for _ in range(60):
        rows = [(1, i, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["A.", "B.", "C", "", "D?"])) for i in range(rnd.randint(0, 4))]
        assert backwards(rows) == (every_audit(rows) if rows else (0, ""))


@pytest.mark.parametrize("size", [P.BLOCK, 2])
def test_equals_brute_force(spark, size):
    rows = talks(60, 4, 1)
    assert got(P.structure_report(table(spark, rows), size)) == report(rows, backwards)
    short = [r for r in rows if sum(x[0] == r[0] for x in harmed(rows)) <= 4]
    want = report(short, every_audit)
    assert want == {c: v for c, v in report(rows, backwards).items() if c in want}


@pytest.mark.parametrize("size", [P.BLOCK, 7])
def test_long_conversations_cross_blocks_and_tasks(spark, size):
    rows = talks(3, 400, 5)
    rnd = random.Random(9)
    rows += [(77, i, rnd.choice(["user", "assistant"]), f"Turn {i}.", "", 0) for i in range(1500)]
    rows += [(78, 5, "user", "Same.", "", 0)] * 900
    assert got(P.structure_report(table(spark, rows), size)) == report(rows, backwards)


def test_turns_come_out_in_their_places(spark):
    rows = [(1, 0, "user", "Hi.", "", 0), (1, 1, "user", "Well?", "", 0), (1, 2, "system", "Oh.", "", 0)]
    _, fixed = P.repair(table(spark, rows))
    out = sorted(map(tuple, fixed.select("conv_id", "place", "edit", "role", "text").collect()))
    assert out == [(1, 0, "K", "user", "Hi."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "Well?"), (1, 3, "R", "assistant", "Oh.")]
    letters = backwards([(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (1, 2, "system", "Oh.")])[1]
    assert "".join(r["edit"] for r in fixed.orderBy("place").collect()) == letters.replace("D", "")


def test_empty_and_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.structure_report(empty).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = got(P.structure_report(table(spark, [(gone, 0, "user", "Hi.", "", 0)])))
    assert out == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
