"""Scalar feature functions.

All helpers accept a column name or a ``Column`` and return a ``Column``.  The
NULL rules are spelled out instead of relying on session flags: ``size(NULL)``
is ``-1`` with ANSI off and ``NULL`` with ANSI on, so ``part_count`` tests the
NULL itself and gives the same answer under both.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The patterns and fill values the derived features must reproduce.
LETTERS_PATTERN = r"([A-Za-z]+)"           # first run of ASCII letters
TITLE_PATTERN = r"([A-Za-z]+)\."           # word directly before a dot
BRACKET_PATTERN = r"\(([A-Za-z ]+)\)"      # letters and blanks inside round brackets
MISSING = "missing"                        # fill value for absent categories


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_empty(c: ColumnOrName) -> Column:
    """``x`` when it has at least one character, else NULL (NULL stays NULL)."""
    x = _col(c)
    return F.when(F.length(x) > 0, x)


def letters_token(c: ColumnOrName, pattern: str = LETTERS_PATTERN) -> Column:
    """First run of letters, upper-cased; no letters or NULL input give NULL."""
    token = F.regexp_extract(_col(c), pattern, 1)
    return F.when(F.length(token) > 0, F.upper(token))


def title_before_dot(c: ColumnOrName, pattern: str = TITLE_PATTERN) -> Column:
    """Word before the first dot that follows letters; ``''`` when absent, NULL for NULL."""
    return F.regexp_extract(_col(c), pattern, 1)


def bracket_text(c: ColumnOrName, pattern: str = BRACKET_PATTERN) -> Column:
    """Text inside brackets made of letters and blanks only, else NULL."""
    return null_if_empty(F.regexp_extract(_col(c), pattern, 1))


def first_char(c: ColumnOrName) -> Column:
    """First character; ``''`` stays ``''`` and NULL stays NULL (no array index, so no ANSI error)."""
    return F.substring(_col(c), 1, 1)


def part_count(c: ColumnOrName, sep: str = " ") -> Column:
    """Number of ``sep``-separated parts as a string; NULL counts as ``'0'``.

    ``'A  B'`` has three parts and ``''`` has one, as a plain split gives.
    """
    x = _col(c)
    n = F.size(F.split(x, re.escape(sep)))
    return F.when(x.isNull(), F.lit("0")).otherwise(n.cast("string"))


def round_half_up(c: ColumnOrName, scale: int = 0) -> Column:
    """Round half away from zero; the type stays double."""
    return F.round(_col(c), scale)


def nan_to_null(c: ColumnOrName) -> Column:
    """Floating NaN becomes NULL; other values pass through."""
    x = _col(c)
    return F.when(~F.isnan(x), x)


def presence_flag(c: ColumnOrName) -> Column:
    """``'1'`` when the value is present, else ``'0'`` (a string, never NULL)."""
    return F.when(_col(c).isNotNull(), F.lit("1")).otherwise(F.lit("0"))


def fill_constant(c: ColumnOrName, value: str = MISSING) -> Column:
    """Replace NULL by a constant."""
    return F.coalesce(_col(c), F.lit(value))


def flag_to_double(c: ColumnOrName) -> Column:
    """A ``'0'``/``'1'`` flag as a number; an absent flag counts as ``0.0``."""
    return F.coalesce(_col(c), F.lit("0")).cast("double")
