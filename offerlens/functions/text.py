"""Text normalization as column expressions (all evaluated in the JVM)."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.constants import CURRENCY_TOKENS, SEPARATOR_CLASS

_MARKS = "".join(chr(c) for c in range(0x300, 0x370))
# JavaScript-style white space, for trim and collapse
SPACE_CLASS = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@lru_cache(maxsize=1)
def _mark_table() -> tuple[str, str]:
    """Characters whose decomposition without marks is one other character."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        bare = unicodedata.normalize("NFD", char)
        if bare == char:
            continue
        bare = "".join(c for c in bare if c not in _MARKS)
        if len(bare) == 1 and bare != char:
            source.append(char)
            target.append(bare)
    # translate() deletes the characters that have no counterpart
    return "".join(source) + _MARKS, "".join(target)


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """The accent table plus every separator turned into a plain space."""
    is_separator = re.compile(f"[{SEPARATOR_CLASS}]", re.ASCII).fullmatch
    separators = "".join(c for c in map(chr, range(0x10000)) if is_separator(c) and c != " ")
    source, target = _mark_table()
    accented = source[: len(target)]
    target = "".join(" " if is_separator(c) else c for c in target)
    return separators + accented + _MARKS, " " * len(separators) + target


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"[{SPACE_CLASS}]+", " ")


def blank_to_null(text: Column) -> Column:
    return F.nullif(trim_space(text), F.lit(""))


def remove_diacritics(text: Column) -> Column:
    """Strip accents. Pure ASCII values skip the character map."""
    source, target = _mark_table()
    return F.when(
        text.rlike(r"[^\x00-\x7f]"), F.translate(text, source, target)
    ).otherwise(text)


def _add_currency(tokens: Column) -> Column:
    def with_codes(token: Column) -> Column:
        codes = [
            F.when(F.contains(token, F.lit(symbol)), F.lit(code))
            for symbol, code in CURRENCY_TOKENS
        ]
        return F.array_compact(F.array(token, *codes))

    return F.flatten(F.transform(tokens, with_codes))


def _add_regions(tokens: Column) -> Column:
    def with_regions(token: Column, i: Column) -> Column:
        following = F.get(tokens, i + 1)
        return (
            F.when((token == "u") & (following == "s"), F.array(token, F.lit("us"), F.lit("usa")))
            .when((token == "u") & (following == "k"), F.array(token, F.lit("uk")))
            .when(token == "eeuu", F.array(token, F.lit("us"), F.lit("usa")))
            .when(token == "latinoamerica", F.array(token, F.lit("latam")))
            .otherwise(F.array(token))
        )

    return F.flatten(F.transform(tokens, with_regions))


def normalize_tokens(text: Column) -> Column:
    """Lower-case, accent-free tokens with currency and region variants.

    One character map strips accents and blanks out the separators, so the
    split is a plain one. The per-token steps run only for texts that hold a
    currency symbol or a region token.
    """
    symbols = "".join("\\" + s if s == "$" else s for s, _ in CURRENCY_TOKENS)
    triggers = F.array(F.lit("u"), F.lit("eeuu"), F.lit("latinoamerica"))
    words = let(
        F.translate(F.lower(text), *_fold_table()),
        lambda s: let(
            F.array_remove(F.split(s, " "), ""),
            lambda t: F.when(s.rlike(f"[{symbols}]"), _add_currency(t)).otherwise(t),
        ),
    )
    return let(
        words,
        lambda t: F.when(F.arrays_overlap(t, triggers), _add_regions(t)).otherwise(t),
    )


def tokens_or_empty(text: Column) -> Column:
    return F.coalesce(normalize_tokens(text), F.array().cast("array<string>"))
