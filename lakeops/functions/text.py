"""Text cleaning and formatting as Column expressions (JVM side, inside generated code)."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters a shift cipher moves, and the cell value that replaces an over-long cell.
UPPER = string.ascii_uppercase
LOWER = string.ascii_lowercase
LONG_CELL_VALUE = "0"
DEFAULT_MAX_LENGTH = 100


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_long(column: str | Column, max_length: int = DEFAULT_MAX_LENGTH, value: str = LONG_CELL_VALUE) -> Column:
    """A cell longer than ``max_length`` characters (strictly) becomes ``value``."""
    c = _c(column)
    return F.when(F.length(c) > F.lit(max_length), F.lit(value)).otherwise(c)


def _rotated(shift: int) -> tuple[str, str]:
    s = shift % 26
    return UPPER[s:] + UPPER[:s] + LOWER[s:] + LOWER[:s], UPPER + LOWER


def shift_encode(column: str | Column, shift: int) -> Column:
    """Move every ASCII letter ``shift`` places forward, keeping case; other characters stay."""
    shifted, plain = _rotated(shift)
    return F.translate(_c(column), plain, shifted)


def shift_decode(column: str | Column, shift: int) -> Column:
    """Inverse of :func:`shift_encode` (shift taken modulo 26; accented letters stay as they are)."""
    shifted, plain = _rotated(shift)
    return F.translate(_c(column), shifted, plain)


def base64_text(column: str | Column) -> Column:
    """UTF-8 bytes of the text as one line of base64 (no line breaks, whatever the session's chunking)."""
    return F.regexp_replace(F.base64(F.encode(_c(column), "UTF-8")), "[\\r\\n]", "")


def base64_decode(column: str | Column) -> Column:
    """Base64 to UTF-8 text; line breaks inside the code are accepted."""
    return F.decode(F.unbase64(_c(column)), "UTF-8")


def round_money(column: str | Column, digits: int = 2) -> Column:
    """Null-safe rounding of a money value read as text: the text becomes a decimal of 18 places (no binary
    error), is rounded half-even once, and returns as double. A number beyond that decimal's range is
    rounded as double; text that is no number gives null."""
    as_text = _c(column).cast("string")
    exact = F.bround(as_text.try_cast("decimal(38,18)"), digits).cast("double")
    return F.coalesce(exact, F.bround(as_text.try_cast("double"), digits))


def pad_cell(column: str | Column, width: int) -> Column:
    """Left-aligned to ``width`` with spaces; a longer value is kept whole (never cut)."""
    c = _c(column)
    return F.when(F.length(c) < F.lit(width), F.rpad(c, width, " ")).otherwise(c)


def report_line(cells: list[Column], widths: list[int | None], sep: str = " | ") -> Column:
    """Fixed-width report line: each cell padded to its width (None: as is), joined by ``sep``; a null cell is empty."""
    filled = [F.coalesce(c, F.lit("")) for c in cells]
    parts = [pad_cell(c, w) if w else c for c, w in zip(filled, widths)]
    return F.concat_ws(sep, *parts)


def separator(length: Column | int, char: str = "-") -> Column:
    n = F.lit(length) if isinstance(length, int) else length
    return F.repeat(F.lit(char), n)


def shares_label(symbol: str | Column, quantity: str | Column) -> Column:
    """Text template ``"SYMBOL (QTY shares)"``."""
    return F.concat(_c(symbol).cast("string"), F.lit(" ("), _c(quantity).cast("string"), F.lit(" shares)"))
