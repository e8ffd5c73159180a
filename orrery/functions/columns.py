"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A decimal number as text: sign, whole part, fraction.
_DECIMAL = r"^[\x00-\x20]*([+-]?)([0-9]*)\.[0-9]*[\x00-\x20]*$"
_WHOLE = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def lenient_cast(c: str | Column, to: str) -> Column:
    """Malformed text becomes null instead of failing the job (ANSI-safe).

    To whole numbers, decimal text is cut to its whole part, as a cast without
    ANSI rules does: ``12.0`` and ``12.7`` are 12, ``-3.9`` is -3, ``.5`` and
    ``.`` are 0; exponents, blanks inside and overflow are null."""
    col = _col(c)
    if to in _WHOLE:
        # The sign, a zero and the whole part; other text stays as it is.
        col = F.regexp_replace(col.cast("string"), _DECIMAL, "$10$2")
    return col.try_cast(to)


def sentinel_flag(c: str | Column, sentinel: str) -> Column:
    """True where the raw value equals the sentinel; null stays null."""
    return _col(c) == F.lit(sentinel)


def sentinel_to_null(c: str | Column, sentinel, to: str | None = None) -> Column:
    """Sentinel -> null, otherwise (optionally) a lenient cast.

    A text sentinel is compared before the cast; a numeric one after it.
    """
    col = _col(c)
    if isinstance(sentinel, str):
        cast = lenient_cast(col, to) if to else col
        return F.when(col == F.lit(sentinel), F.lit(None)).otherwise(cast)
    cast = lenient_cast(col, to) if to else col
    return F.nullif(cast, F.lit(sentinel))


def trimmed(c: str | Column) -> Column:
    """Strip blanks (spaces only) at both ends."""
    return F.trim(_col(c))


def blank_to_null(c: str | Column) -> Column:
    """Trim, then map the empty string to null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def literal_alternation(words: Iterable[str]) -> str:
    """Regex matching any of the words as literal substrings."""
    return "|".join(re.escape(w) for w in words)


def round2(c: str | Column, digits: int = 2) -> Column:
    """Half-away-from-zero rounding of a float via decimal(18,6), as double.

    The decimal step absorbs last-bit noise of float sums so that two engines
    agree on the rounded digits.
    """
    return F.round(_col(c).cast("decimal(18,6)"), digits).cast("double")


def payload_json(columns: Iterable[str]) -> Column:
    """JSON object of the given columns; null fields are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def hash_percent(*cols: str | Column) -> Column:
    """Stable bucket 0..99 of a key: first 32 bits of md5 of "a:b:...".

    Independent of partitioning and of the engine, so splits and samples
    are reproducible on any layout.
    """
    key = F.concat_ws(":", *[_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100


def hash_order(*cols: str | Column) -> Column:
    """Full md5 hex of the key, for a seeded but layout-free order."""
    return F.md5(F.concat_ws(":", *[_col(c).cast("string") for c in cols]))
