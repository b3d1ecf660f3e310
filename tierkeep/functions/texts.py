"""Text, array and change-hash column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case words that mark an entry as an add-on rather than an item of its own.
ADD_ON_WORDS = (
    "soundtrack",
    "ost",
    " ost",
    " dlc",
    "dlc ",
    "pack",
    "bundle",
    "demo",
    "beta test",
    "dedicated server",
    "sdk",
    "tool",
    "editor",
    "skin pack",
    "costume",
    "art book",
    "artbook",
    "wallpaper",
    "bonus content",
    "pre-order",
    "preorder",
    "season pass",
    "expansion pass",
    "supporter",
    "upgrade",
)

# Field separator and NULL marker of the change hash.
HASH_SEPARATOR = "||"
HASH_NULL = "__NULL__"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions, F.lit(False))


def mentions(text: Column, words: Sequence[str] = ADD_ON_WORDS, whole_word: bool = False) -> Column:
    """True when the lower-cased text holds any of the words (as substrings by default)."""
    if whole_word:
        choices = "|".join(re.escape(word.strip()) for word in words)
        return F.lower(text).rlike(rf"\b(?:{choices})\b")
    # a word that holds another one of the list cannot add a match
    needed = [word for word in words if not any(other != word and other in word for other in words)]
    # the one-element array binds the lower-cased text, which would else be made anew per word
    return F.exists(F.array(F.lower(text)), lambda lowered: any_of(F.contains(lowered, F.lit(w)) for w in needed))


def joined(values: Column, separator: str = ", ") -> Column:
    """Array as text; NULL array gives empty text and NULL items are left out."""
    return F.concat_ws(separator, values)


def pick(array: Column, field: str) -> Column:
    """Array of structs to an array of one of its fields."""
    return F.transform(array, lambda item: item.getField(field))


def digits_or_zero(text: Column) -> Column:
    """Digit text to int; any other text to 0; NULL to 0."""
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    return F.coalesce(number, F.lit(0))


def change_hash(columns: Sequence[Column]) -> Column:
    """md5 over the text of the columns, NULL spelled out."""
    parts = [F.coalesce(c.cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs, NULL being equal to NULL only."""
    return any_of(~a.eqNullSafe(b) for a, b in zip(left, right, strict=True))
