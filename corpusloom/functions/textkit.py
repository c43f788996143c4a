"""Text primitives with the semantics of Python's regular expressions, as Column expressions.

Word characters are letters, numbers and the underscore, and exclude combining marks, so a word boundary
falls inside Indic clusters. Java's own ``\\b`` counts marks as word characters and isn't used.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_CHAR = r"[\p{L}\p{N}_]"
_IS_WORD = lambda c: c.isalnum() or c == "_"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    Spelled-out reuse would copy the value's whole expression to each place, and generated code with it.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


#: Rows whose results an Arrow function holds as Python objects at a time.
PIECE = 256


def each(f: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``f`` of each row, as an Arrow array; a piece of the rows at a time is held as Python objects."""
    pieces = [pa.array([f(*(x.as_py() for x in row)) for row in zip(*(c.slice(at, PIECE) for c in columns))], kind) for at in range(0, len(columns[0]), PIECE)]
    return pa.concat_arrays(pieces) if pieces else pa.array([], kind)


def words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_extract_all(text, F.lit(f"{WORD_CHAR}+"), F.lit(0))


def ascii_tokens(text: Column) -> Column:
    """Lower-cased words made of a-z only; a word with any other character gives none."""
    return F.filter(words(F.lower(text)), lambda w: w.rlike("^[a-z]+$"))


def edge_before(first: str) -> str:
    """Look-around for a word boundary before a pattern that starts with the given character."""
    return f"(?<!{WORD_CHAR})" if _IS_WORD(first) else f"(?<={WORD_CHAR})"


def edge_after(last: str) -> str:
    return f"(?!{WORD_CHAR})" if _IS_WORD(last) else f"(?={WORD_CHAR})"


def quote(literal: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 or c in " _" else "\\" + c for c in literal)


def whole(literal: str) -> str:
    """A pattern for the literal between word boundaries."""
    return edge_before(literal[0]) + quote(literal) + edge_after(literal[-1])


def bounded(body: str) -> str:
    """A pattern whose body starts and ends with word characters, between word boundaries."""
    return f"(?<!{WORD_CHAR})(?:{body})(?!{WORD_CHAR})"


def strip(text: Column) -> Column:
    """Without white space at either end, as Unicode has it."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(strip(text)) == 0)


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end,text>> of all matches; offsets count code points.

    The pattern has no capturing groups, and the text no U+0001 (cleaned texts have none).
    """
    mark = "\u0001"
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{mark}$1{mark}"), mark, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), empty.alias("found"))

    def step(acc: Column, part: Column) -> Column:
        stop = acc["at"] + F.length(part)
        span = F.struct(acc["at"].alias("start"), stop.alias("end"), part.alias("text"))
        found = F.when(acc["i"] % 2 == 1, F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(stop.alias("at"), (acc["i"] + 1).alias("i"), found.alias("found"))

    return F.coalesce(F.aggregate(parts, start, step, lambda acc: acc["found"]), empty)


def or_default(value: Column, default: Column | str) -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default) if isinstance(default, str) else default)
