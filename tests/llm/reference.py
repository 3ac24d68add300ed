"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    grams = [tuple(words[i : i + 5]) for i in range(n - 4)]
    seen = collections.Counter(grams)
    repeated = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": n < 10 or 100 * len(repeated) > 20 * n,
    }


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, shingle=3):
    import xxhash

    words = WORD.findall(ascii_lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closest(members, related):
    """Union-find over all pairs: index of each member's group."""
    parent = list(range(len(members)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(members)):
        for j in range(i):
            if related(members[i], members[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(members))]


def simhash_groups(rows, distance=2):
    """{position: (fingerprint, smallest id of the group)} of (doc_id, text) rows."""
    prints = [simhash(t) for _, t in rows]
    values = sorted(set(prints))
    at = dict(zip(values, closest(values, lambda a, b: (a ^ b).bit_count() <= distance)))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[at[p]] = min(i, least.get(at[p], i))
    return [(i, f"{p:016x}", least.get(at[p])) for (i, _), p in zip(rows, prints)]


def earlier_bytes(rows, length=100):
    """(doc_id, bytes, covered flags) of (doc_id, text) rows in order of doc_id."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for at in range(len(b) - length + 1):
            w = b[at : at + length]
            if w in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(w)
        out.append((i, b, gone))
    return out


def suffix_digest(rows, length=100):
    out = []
    for i, b, gone in earlier_bytes(rows, length):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
