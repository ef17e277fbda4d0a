"""Text functions, Column -> Column.

Each function but `nfc` is one chain in which the input occurs once, so a long regular-expression
chain is never evaluated twice per row. Only Unicode composition leaves the JVM.
"""

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from sonoloom import fixed_values as V

_DIGITS = rf"\p{{Nd}}{V.OTHER_DIGITS}{V.NEWER_DECIMAL_DIGITS}"


def _class(points: list[int]) -> str:
    """A regular-expression class of code points; the first test keeps it cheap for all below U+0300."""
    edges = [i for i, p in enumerate(points) if not i or p != points[i - 1] + 1]
    runs = [(points[a], points[b - 1]) for a, b in zip(edges, [*edges[1:], len(points)])]
    return r"[\x{300}-\x{10FFFF}&&[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs) + "]]"


@lru_cache
def may_compose() -> str:
    """A pattern that every text holds which NFC changes: the Unicode quick check.

    These are code points that NFC replaces or that may compose with one before, and marks in a row, which may be in
    another order than the canonical one. There are none below U+0300.
    """
    changing, marks = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3)), []
    for point in (*range(0x300, 0xD800), *range(0xE000, 0x110000)):
        c = chr(point)
        if unicodedata.combining(c):
            marks.append(point)
        parts = unicodedata.decomposition(c).split()
        if parts and not parts[0].startswith("<"):
            if unicodedata.normalize("NFC", c) != c:
                changing.add(point)
    for point in range(0xC0, 0x30000):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            changing.add(int(parts[1], 16))
    return f"{_class(sorted(changing))}|{_class(marks)}{{2}}"


@F.arrow_udf(StringType())
def _composed(text: pa.Array) -> pa.Array:
    return pa.array(
        [None if t is None else unicodedata.normalize("NFC", t) for t in text.to_pylist()],
        pa.string(),
    )


def may_change(text: Column) -> Column:
    """Whether NFC may change a text: cheap tests first, which ASCII and then Latin texts do not pass."""
    beyond = text.rlike(r"[\x{300}-\x{10FFFF}]")
    return (F.octet_length(text) > F.length(text)) & beyond & text.rlike(may_compose())


def nfc(text: Column) -> Column:
    """Canonical composition (NFC); Spark has no built-in for it. [T1]

    Only texts that fail the quick check are carried to Python. The input occurs several times: give it a column.
    """
    return F.coalesce(_composed(F.when(may_change(text), text)), text)


def base_language(code: Column) -> Column:
    """Language part of a code: 'zh_Hans' -> 'zh'. [T12]"""
    return F.lower(F.substring_index(code, "_", 1))


def _punctuation_class(language: str | None = None) -> str:
    marks = V.ASCII_PUNCTUATION + V.CJK_PUNCTUATION.get(language, "")
    return "[" + "".join(re.escape(m) for m in marks) + "]+"


def remove_punctuation(text: Column, language: Column | str = "default") -> Column:
    """Delete the punctuation of the row's language; `language` is a code or a column. [T2]"""
    if isinstance(language, str):
        key = language.split("_")[0].lower()
        return F.regexp_replace(text, _punctuation_class(key), "")
    key, cases = base_language(language), F
    for known in V.CJK_PUNCTUATION:
        cases = cases.when(key == known, F.regexp_replace(text, _punctuation_class(known), ""))
    return cases.otherwise(F.regexp_replace(text, _punctuation_class(), ""))


def squeeze_whitespace(text: Column) -> Column:
    """Turn every run of Unicode white space into one space and strip the ends. [T4]"""
    return F.trim(F.regexp_replace(text, V.WHITESPACE_RUN, " "))


def strip_brackets(text: Column) -> Column:
    """Delete [..], <..>, {..} and (..) in that order, shortest match, within a line. [T5]"""
    for opening, closing in V.BRACKETS:
        # (?d): only \n ends a line
        text = F.regexp_replace(text, rf"(?d)\{opening}.*?\{closing}", "")
    return text


def keeps_non_digits(text: Column) -> Column:
    """False for a text that holds nothing but digits and spaces, and at least one digit. [T6]"""
    return ~F.replace(text, F.lit(" "), F.lit("")).rlike(rf"\A[{_DIGITS}]+\z")


def normalise_or_empty(
    text: Column,
    language: Column | str,
    lower_case: bool = True,
    drop_digit_only: bool = False,
    remove_brackets: bool = False,
) -> Column:
    """`normalise`, with '' in place of NULL."""
    text = nfc(text)
    if remove_brackets:
        text = strip_brackets(text)
    text = remove_punctuation(text, language)
    if lower_case:
        text = F.lower(text)
    text = squeeze_whitespace(text)
    if drop_digit_only:
        # the text is squeezed: it is digit-only iff it is made of digits and single spaces
        text = F.regexp_replace(text, rf"\A[ {_DIGITS}]+\z", "")
    return F.coalesce(text, F.lit(""))


def normalise(
    text: Column,
    language: Column | str,
    lower_case: bool = True,
    drop_digit_only: bool = False,
    remove_brackets: bool = False,
) -> Column:
    """Normalised text, or NULL where nothing is left or the text is dropped. [T7]"""
    return F.nullif(
        normalise_or_empty(text, language, lower_case, drop_digit_only, remove_brackets),
        F.lit(""),
    )


def clean_transcript(text: Column, remove_punctuation: bool = False) -> Column:
    """Delete {translations}, <tags> and runs of dashes from a transcript; NULL gives ''. [T9, T10]"""
    for pattern in V.TRANSCRIPT_NOISE:
        text = F.regexp_replace(text, pattern, "")
    if remove_punctuation:
        text = F.translate(text, V.TRANSCRIPT_PUNCTUATION, "")
    return F.coalesce(squeeze_whitespace(text), F.lit(""))
