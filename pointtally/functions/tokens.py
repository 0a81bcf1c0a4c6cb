"""Text tokenizing with the reference's Java string semantics, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators recognised by a Hadoop text scan.
LINE_BREAK_PATTERN = r"\r\n|\r|\n"

# An integer literal (optional sign, ASCII digits, nothing else; no
# surrounding whitespace).
INT_PATTERN = r"^[+-]?[0-9]+$"


def java_space_split(text: Column) -> Column:
    """``text.split(" ")`` with Java's rules, as an ``ARRAY<STRING>`` column.

    Java keeps leading and interior empty tokens, drops trailing ones, turns
    an empty string into ``[""]`` and an all-space string into ``[]``.  Spark's
    ``split`` keeps trailing empties, so the trailing spaces are trimmed first
    (``rtrim`` removes only U+0020, like the split character).
    """
    trimmed = F.rtrim(text)
    return (
        F.when(text == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def split_lines(text: Column) -> Column:
    """Lines of a multi-line text cell (``\\n``, ``\\r\\n`` or ``\\r`` breaks), as a text scan reads them.

    A final break ends the last line and opens no further one; an empty text
    has no line.
    """
    pieces = F.split(text, LINE_BREAK_PATTERN)
    last_empty = F.element_at(pieces, -1) == F.lit("")
    return F.when(last_empty, F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def line_count(text: Column) -> Column:
    """Number of :func:`split_lines` lines, counted without splitting."""

    def occurrences(piece: str) -> Column:
        without = F.length(F.replace(text, F.lit(piece), F.lit("")))
        return ((F.length(text) - without) / F.lit(len(piece))).cast("bigint")

    breaks = occurrences("\n") + occurrences("\r") - occurrences("\r\n")
    open_end = (text != F.lit("")) & ~text.endswith("\n") & ~text.endswith("\r")
    return breaks + open_end.cast("bigint")


def strict_int(token: Column, what: str = "index") -> Column:
    """Token → BIGINT, failing the job on anything but an optional sign and ASCII digits.

    Stricter than Spark's cast, which trims white space; wider than Java's
    ``parseInt`` in range (64 bits) and narrower in digits (ASCII only).
    """
    return F.when(token.rlike(INT_PATTERN), token.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit(f"malformed {what}: "), F.coalesce(token, F.lit("<missing>"))))
    )
