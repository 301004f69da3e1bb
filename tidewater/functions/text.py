"""Text helpers: tokenising with the reference's split rule, tuple formatting.

All JVM-side expressions; nothing here leaves whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import formats


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(value: Column | str, sep: str = " ") -> Column:
    """``String.split(sep)`` for a single literal character.

    Java keeps leading and inner empty strings, drops *trailing* ones, keeps
    ``[""]`` for the empty string and gives ``[]`` for a string made only of
    ``sep``. Spark's ``split`` keeps trailing empties, so strip them first.
    """
    v = _c(value)
    if sep == " ":
        stripped = F.rtrim(v)
    else:
        stripped = F.regexp_replace(v, "(" + _regex_quote(sep) + ")+$", "")
    return (F.when((v != F.lit("")) & (stripped == F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, _regex_quote(sep))))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def tokens(df: DataFrame, col: str = "value", out: str = "word", sep: str = " ") -> DataFrame:
    """flatMap line -> words (P1). Empty words are words, as in the reference."""
    return df.select(F.explode(java_split(col, sep)).alias(out))


def tuple_text(*cols: Column | str) -> Column:
    """Tuple rendering ``(a,b)`` as written by ``writeAsText`` (K2)."""
    parts = [_c(c).cast("string") for c in cols]
    if len(parts) == 2:
        return F.format_string(formats.TUPLE_FORMAT, *parts)
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def pair_text(key: Column | str, value: Column | str, sep: str = formats.PAIR_SEPARATOR) -> Column:
    """``key + sep + value`` (P10): ``word:::count`` and ``word:count``."""
    return F.concat(_c(key).cast("string"), F.lit(sep), _c(value).cast("string"))
