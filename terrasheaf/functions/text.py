"""Text columns: whitespace cleaning, search normal form, query tokens."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from ..session import ship

# The shortest token of the search contract.
MIN_TOKEN_LENGTH = 2

# str.split() in the reference semantics also breaks on the four ASCII separators.
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def clean_text(col: Column) -> Column:
    """NULL becomes empty; runs of whitespace become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), _SPACE, " "))


def clean_list(col: Column) -> Column:
    """Cleaned, non-blank, distinct items in their first order; NULL becomes empty."""
    items = F.coalesce(col, F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(items, clean_text), lambda x: x != ""))


class _Letters(dict):
    """For ``str.translate``: what stands for each code point, worked out when it first occurs.

    Marks vanish, letters and digits stay (lower-cased if asked), all else is a space.
    """

    def __init__(self, lower: bool):
        super().__init__()
        self.lower = lower

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        if unicodedata.combining(letter):
            stands = ""
        elif letter.isalnum():
            stands = letter.lower() if self.lower else letter
        else:
            stands = " "
        self[code] = stands
        return stands


# Tables fill up once per worker; they hold no more than the code points in use.
_AFTER, _BEFORE = _Letters(True), _Letters(False)


@F.pandas_udf(T.StringType())
def _fold_pack(values: pd.Series) -> pd.Series:
    return values.str.normalize("NFKD").str.translate(_AFTER).str.split().str.join(" ")


@F.pandas_udf(T.StringType())
def _fold_query(values: pd.Series) -> pd.Series:
    return values.str.lower().str.normalize("NFKD").str.translate(_BEFORE).str.split().str.join(" ")


def normalize_ascii(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))


def is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def normalize_text(col: Column, variant: str = "pack") -> Column:
    """Accent-free lower-case words joined by one space.

    ``pack`` strips marks and then lowers, ``query`` lowers first; they differ on
    compatibility letters only.  ASCII rows stay in generated code: the Arrow
    function gets NULL for them, so only text it must change crosses to Python.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        ship(session)
    text = F.coalesce(col, F.lit(""))
    udf = _fold_pack if variant == "pack" else _fold_query
    ascii_row = is_ascii(text)
    return F.when(ascii_row, normalize_ascii(text)).otherwise(udf(F.when(~ascii_row, text)))


def words(norm: Column) -> Column:
    """Words of an already normalised text (no empty word)."""
    return F.filter(F.split(norm, " "), lambda w: w != "")


def query_tokens(norm: Column, limit: int | None = None) -> Column:
    """Distinct tokens of at least two characters in first order; ``limit`` cuts them, by default none is."""
    tokens = F.array_distinct(
        F.filter(F.split(norm, " "), lambda t: F.char_length(t) >= MIN_TOKEN_LENGTH)
    )
    return tokens if limit is None else F.slice(tokens, 1, limit)
