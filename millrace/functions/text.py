"""Text functions for HTML pages and question-answer documents."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup removed with its content, and markup removed alone; a quoted value may hold a >.
DROPPED_BLOCKS = [r"(?is)<!--.*?-->", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>"]
ANY_TAG = r"""(?s)<[A-Za-z/!?][^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
BROKEN_TAG = r"(?s)<[A-Za-z/!?][^>]*>"  # with a quote that never closes


#: A reference at the start of what follows an ampersand: a number, or a name.
REFERENCE = r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]{0,31})(;?)"


def _names(closed: bool) -> Column:
    """The standard's named references, from the standard library: those that need a semicolon, or the old ones that do not."""
    names = {n.rstrip(";"): c for n, c in html5.items() if n.endswith(";") == closed}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(point: Column) -> Column:
    """A code point as text; numbers that are none become U+FFFD, 128 to 159 what Windows-1252 has there."""
    old = {i: bytes([i]).decode("cp1252", "replace") for i in range(128, 160)}
    legacy = F.element_at(F.from_json(F.lit(json.dumps(old)), "map<string,string>"), point.cast("string"))
    wide = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return F.when(point.between(128, 159), legacy).when(valid, wide).otherwise(F.lit("\ufffd"))


def _decoded(piece: Column) -> Column:
    """What an ampersand and the text after it stand for; unknown references stay."""
    name, end = F.regexp_extract(piece, REFERENCE, 1), F.regexp_extract(piece, REFERENCE, 2)
    rest = piece.substr(F.length(name) + F.length(end) + 1, F.length(piece))
    number = F.when(name.rlike("^#[xX]"), F.conv(F.regexp_replace(name, "^#[xX]", ""), 16, 10)).otherwise(F.regexp_replace(name, "^#", ""))
    known = F.when(end == ";", F.element_at(_names(True), name)).otherwise(F.element_at(_names(False), name))
    char = F.when(name.startswith("#"), _character(number.cast("long"))).otherwise(known)
    return F.coalesce(F.concat(F.when(name != "", char), rest), F.concat(F.lit("&"), piece))


def unescaped(col: Column) -> Column:
    """Character references of HTML decoded, once: what they yield is not read again. Old names are read as whole words only."""
    pieces = F.split(col, "&")
    after = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _decoded)
    return F.when(F.contains(col, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(after, ""))).otherwise(col)


def html_to_text(col: Column) -> Column:
    """Visible text of a page: blocks, comments and tags out, references decoded, blanks squeezed."""
    for pattern in (*DROPPED_BLOCKS, ANY_TAG, BROKEN_TAG):
        col = F.regexp_replace(col, pattern, " ")
    return F.trim(F.regexp_replace(unescaped(col), "[ \\t\\r\\n\u00a0]+", " "))


def chunks(col: Column, size: int = 1000, overlap: int = 100) -> Column:
    """Overlapping character windows that cover the whole text; the last one may be shorter."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(col) - size) / F.lit(float(step))).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: col.substr(i * step + 1, F.lit(size)))


def spread_sentences(col: Column, limit: int) -> Column:
    """Whole sentences of about ``limit`` characters in all, taken evenly from begin to end of the text.

    The text is cut after sentence ends into n sentences; every m-th one is kept, m being the length of the text over
    ``limit``, rounded up. The first sentence is always among them.
    """
    every = F.greatest(F.lit(1), F.ceil(F.length(col) / F.lit(float(limit))).cast("int"))
    sentences = F.split(col, r"(?<=[.!?])\s+")
    return F.array_join(F.filter(sentences, lambda s, i: i % every == 0), " ")


def word_count(col: Column) -> Column:
    """Whitespace-separated words."""
    return F.when(F.length(F.trim(col)) == 0, 0).otherwise(F.size(F.split(F.trim(col), r"\s+")))
