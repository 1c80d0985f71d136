"""Column functions beyond Spark's built-ins, composed of built-ins only."""

from __future__ import annotations

import re
import string

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Month names in order.
MONTH_SHORT = "jan feb mar apr may jun jul aug sep oct nov dec".split()
MONTH_LONG = (
    "january february march april may june july august september october november december"
).split()
# Fixed value: the one pair that is spelled differently.
PAIR_SPELLING = {"sep/oct": "sept/oct"}


def _month_pairs(i: int) -> list[str]:
    """The month's name joined with that of the month after it, short and long."""
    after = (i + 1) % 12
    short = f"{MONTH_SHORT[i]}/{MONTH_SHORT[after]}"
    return [PAIR_SPELLING.get(short, short), f"{MONTH_LONG[i]}/{MONTH_LONG[after]}"]


def month_text(text: Column) -> Column:
    """Month names in a text become numbers, other letters, spaces and dots go.

    ``March 2020`` gives ``032020``.  Tokens end at two of ``_`` / ``,`` or at a
    space.  A token that is a pair of months becomes the first one; anywhere else
    a short name is replaced, and what is left of a long name goes with the
    letters.
    """
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    out = F.regexp_replace(lowered, "[_,][_,]", " ")
    paired = out
    for i in range(12):
        either = "|".join(_month_pairs(i))
        paired = F.regexp_replace(paired, f"(?<![^ ])(?:{either})(?![^ ])", f"{i + 1:02d}")
    out = F.when(F.contains(out, F.lit("/")), paired).otherwise(out)
    for i, name in enumerate(MONTH_SHORT):
        out = F.replace(out, F.lit(name), F.lit(f"{i + 1:02d}"))
    return F.regexp_replace(out, "[a-z .]", "")


def wildcard(text: Column, pattern: str) -> Column:
    """Whole-text match with ``*`` (any run) and ``?`` (one character)."""
    parts = {"*": ".*", "?": "."}
    return text.rlike("(?s)^" + "".join(parts.get(ch, re.escape(ch)) for ch in pattern) + "$")


def has_long_value(values: Column, longer_than: int = 5) -> Column:
    """True if any element is longer; NULL lists and elements count as short."""
    return F.coalesce(F.exists(values, lambda v: F.coalesce(F.length(v) > longer_than, F.lit(False))), F.lit(False))


def split_list(text: Column, sep: str = "^") -> Column:
    return F.split(text, re.escape(sep), -1)


def encrypt_text(text: Column, key: Column) -> Column:
    return F.base64(F.aes_encrypt(text, key, F.lit("ECB"), F.lit("PKCS")))


def decrypt_text(text: Column, key: Column) -> Column:
    """Base64 text to plain text."""
    return F.aes_decrypt(F.unbase64(text), key, F.lit("ECB"), F.lit("PKCS")).cast("string")


def _month_text_sql(arg: str) -> str:
    """:func:`month_text` as SQL text."""
    out = f"regexp_replace(translate({arg}, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[_,][_,]', ' ')"
    for i in range(12):
        either = "|".join(_month_pairs(i))
        out = f"regexp_replace({out}, '(?<![^ ])(?:{either})(?![^ ])', '{i + 1:02d}')"
    for i, name in enumerate(MONTH_SHORT):
        out = f"replace({out}, '{name}', '{i + 1:02d}')"
    return f"regexp_replace({out}, '[a-z .]', '')"


def register_sql_functions(spark: SparkSession, names: Mapping[str, str] | None = None) -> None:
    """Make ``month_text`` and ``has_long_value`` callable from rule text.

    They are SQL functions, expanded into the calling expression by the analyzer;
    ``names`` gives them other names.
    """
    names = {"month_text": "month_text", "has_long_value": "has_long_value", **(names or {})}
    spark.sql(
        f"create or replace temporary function {names['month_text']}(t string) returns string "
        f"return {_month_text_sql('t')}"
    )
    spark.sql(
        f"create or replace temporary function {names['has_long_value']}(v array<string>) returns boolean "
        "return coalesce(exists(v, x -> coalesce(length(x) > 5, false)), false)"
    )
