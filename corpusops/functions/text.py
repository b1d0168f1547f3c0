"""String rules shared by every operator, as Column expressions.

Whitespace follows Python's ``str.strip``/``str.split``: the class below names the
characters Java's ``\\s`` leaves out (U+000B, U+001C-U+001F, U+0085, Unicode separators).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"


def py_strip(text: Column | str) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column | str) -> Column:
    """Null or nothing but whitespace. Stops at the first other character."""
    text = F.col(text) if isinstance(text, str) else text
    return ~F.coalesce(text.rlike(WORD), F.lit(False))


def pieces(text: Column | str, separator: str) -> Column:
    """Non-empty parts between separators. Splitting is about twice as fast as extracting matches."""
    return F.array_remove(F.split(text, separator), "")


def py_words(text: Column | str) -> Column:
    return pieces(text, f"{SPACE}+")


def word_count(text: Column | str) -> Column:
    return F.size(py_words(text))


def digest(text: Column) -> Column:
    """32 bytes that stand for a text of any length when texts are grouped or counted."""
    return F.unhex(F.sha2(text, 256))


def contains_any(text: Column, needles: Sequence[str], whole_word: bool = False) -> Column:
    """True if any needle occurs. Substring test unless ``whole_word``."""
    if whole_word:
        return text.rlike(r"\b(" + "|".join(needles) + r")\b")
    hit = F.lit(False)
    for needle in needles:
        hit = hit | text.contains(needle)
    return hit


def present(names_and_flags: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names whose flag holds, in the given order."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in names_and_flags]))


def py_title(text: Column | str) -> Column:
    """``str.title`` for identifier-like names: capital after every run of non-letters."""
    text = F.col(text) if isinstance(text, str) else text
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def join_text(*parts: Column | str) -> Column:
    """Concatenate columns and literal strings (strings here are text, not column names)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
