"""Feature derivations: ``DataFrame -> DataFrame`` functions for ``df.transform``.

Each one is a single projection of built-in expressions, so Catalyst folds it
into the scan's codegen stage and prunes the raw columns it drops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import (
    bracket_text,
    first_char,
    letters_token,
    nan_to_null,
    part_count,
    presence_flag,
    round_half_up,
    title_before_dot,
)


# Default column names of the raw ticket/name tables and of the
# derived feature tables, as the workflow's tables name them.
TICKET, CABIN, FARE = "Ticket", "Cabin", "Fare"
TICKET_CHARS, CABIN_CHAR, CABIN_MULTI, FARE_ROUNDED = "TicketChars", "CabinChar", "CabinMulti", "FareRounded"
NAME, AGE = "Name", "Age"
NAME_PREFIX, NAME_SECONDARY, NAME_MULTIPLE = "NamePrefix", "NameSecondary", "NameMultiple"


def ticket_features(df: DataFrame, *, ticket: str = TICKET, cabin: str = CABIN, fare: str = FARE,
                    out_letters: str = TICKET_CHARS, out_first: str = CABIN_CHAR,
                    out_parts: str = CABIN_MULTI, out_rounded: str = FARE_ROUNDED) -> DataFrame:
    """Ticket-style features.

    Keeps every input column except ``ticket`` and ``cabin`` (in input order) and
    appends: first letter run of the ticket upper-cased (NULL when none), first
    character of the cabin, number of blank-separated cabins as a string (NULL
    cabin -> ``'0'``), fare rounded half up to a whole number.
    """
    kept = [c for c in df.columns if c not in (ticket, cabin)]
    return df.select(
        *kept,
        letters_token(ticket).alias(out_letters),
        first_char(cabin).alias(out_first),
        part_count(cabin).alias(out_parts),
        round_half_up(fare, 0).alias(out_rounded),
    )


def demographic_features(df: DataFrame, *, name: str = NAME, age: str = AGE,
                         out_title: str = NAME_PREFIX, out_bracket: str = NAME_SECONDARY,
                         out_flag: str = NAME_MULTIPLE) -> DataFrame:
    """Name-style features.

    Keeps every input column (``age`` with NaN turned into NULL) and appends the
    word before a dot (``''`` when absent), the bracketed text made of letters
    and blanks (NULL when absent) and a ``'1'``/``'0'`` flag for that text.
    """
    passthrough = [nan_to_null(c).alias(c) if c == age else F.col(c) for c in df.columns]
    with_bracket = df.select(
        *passthrough,
        title_before_dot(name).alias(out_title),
        bracket_text(name).alias(out_bracket),
    )
    # The flag reads the bracket column instead of repeating the regex, so the
    # extraction runs once per row.
    return with_bracket.select("*", presence_flag(out_bracket).alias(out_flag))


def prejoin(left: DataFrame, right: DataFrame, keys: Sequence[str], left_columns: Sequence[str] | None = None,
            right_columns: Sequence[str] | None = None, how: str = "inner") -> DataFrame:
    """Materialisable pre-join of two feature tables on their shared key.

    Only the listed columns of each side are read (the projection reaches the
    scans).  The default ``inner`` join drops keys missing on either side.
    """
    keys = list(keys)
    lcols = [c for c in (left_columns or left.columns) if c not in keys]
    rcols = [c for c in (right_columns or right.columns) if c not in keys]
    clash = set(lcols) & set(rcols)
    if clash:
        raise ValueError(f"both sides carry columns {sorted(clash)}")
    return left.select(*keys, *lcols).join(right.select(*keys, *rcols), keys, how)
