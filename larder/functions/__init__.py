"""Column helpers: every function takes and returns a ``Column`` built from
``pyspark.sql.functions`` only, so derivations stay inside whole-stage codegen."""

from larder.functions.columns import (
    bracket_text,
    fill_constant,
    first_char,
    flag_to_double,
    letters_token,
    nan_to_null,
    null_if_empty,
    part_count,
    presence_flag,
    round_half_up,
    title_before_dot,
)

__all__ = [
    "bracket_text",
    "fill_constant",
    "first_char",
    "flag_to_double",
    "letters_token",
    "nan_to_null",
    "null_if_empty",
    "part_count",
    "presence_flag",
    "round_half_up",
    "title_before_dot",
]
