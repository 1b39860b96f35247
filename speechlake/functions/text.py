"""Text clean-up as column expressions; everything runs in the JVM."""

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the submission format.
PLACEHOLDER = "..."
KEPT_PUNCTUATION = " '-"
NA_LIKE = ["", "nan", "null", "none", "na", "n/a", "<na>"]

_LATIN_1 = 0x100  # Java tests single characters below this with a bit set
_COMBINING = 0x300  # every character below is its own NFC form


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _ranges(points: list[int]) -> str:
    """Body of a regex class for sorted code points."""
    spans: list[list[int]] = []
    for point in points:
        if spans and point == spans[-1][1] + 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans)


@lru_cache(maxsize=1)
def character_classes() -> dict[str, str]:
    """Regex class bodies, derived from the Unicode character database.

    space: white space; kept: white space, digits, Latin letters and the kept punctuation; foreign: letters that are
    not Latin. find_dropped and find_foreign are whole patterns for one character outside kept or inside foreign.
    """
    space, kept, dropped, foreign = [], [], [], []
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        letter = char.isalpha()
        latin = letter and unicodedata.name(char, "").startswith("LATIN ")
        if char.isspace():
            space.append(point)
        if latin or char.isspace() or char.isdigit() or char in KEPT_PUNCTUATION:
            kept.append(point)
        else:
            dropped.append(point)
        if letter and not latin:
            foreign.append(point)
    return {
        "space": _ranges(space),
        "space_low": _singles(p for p in space if p < _LATIN_1),
        "space_high": _ranges([p for p in space if p >= _LATIN_1]),
        "kept": _ranges(kept),
        "foreign": _ranges(foreign),
        "find_dropped": _finder(dropped),
        "find_foreign": _finder(foreign),
    }


def _singles(points: Iterable[int]) -> str:
    return "".join(f"\\x{{{p:X}}}" for p in points)


def _finder(points: list[int]) -> str:
    """Pattern for one of many characters that costs little on Latin text.

    Java walks all ranges of a long class for each character. Characters below 256 are looked up in a bit set instead,
    and the letters up to the combining marks are passed over before the long class is tried.
    """
    wanted = set(points)
    passed = _ranges([p for p in range(_COMBINING) if p < _LATIN_1 or p not in wanted])
    return f"[{_singles(p for p in points if p < _LATIN_1)}]|(?![{passed}])[{_ranges([p for p in points if p >= _LATIN_1])}]"


def nfc(text: str | Column) -> Column:
    """Unicode NFC. Only text with a character from U+0300 up is composed (by the ICU library Spark ships)."""
    text = _column(text)
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(text.rlike(r"[^\x{0}-\x{2FF}]"), composed).otherwise(text)


def keep_latin(text: str | Column) -> Column:
    """Drop everything but white space, digits, Latin letters, ``'`` and ``-``."""
    return F.regexp_replace(_column(text), character_classes()["find_dropped"], "")


def strip(text: str | Column) -> Column:
    """Strip Unicode white space at both ends."""
    space = character_classes()["space"]
    return F.regexp_replace(_column(text), f"\\A[{space}]+|[{space}]+\\z", "")


def squash_spaces(text: str | Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    text, classes = _column(text), character_classes()
    rare = F.regexp_replace(text, f"[{classes['space_high']}]", " ")
    simple = F.when(text.rlike(r"[^\x{0}-\x{167F}]"), rare).otherwise(text)
    return F.trim(F.regexp_replace(simple, f"[{classes['space_low']}]+", " "))


def _stripped_is(text: Column, pattern: str) -> Column:
    """Whether the stripped text matches as a whole; anchored, so long texts are not walked."""
    space = character_classes()["space"]
    return text.rlike(f"\\A[{space}]*(?:{pattern})[{space}]*\\z")


def is_blank(text: str | Column) -> Column:
    """True where text is empty or white space; NULL stays NULL."""
    return _stripped_is(_column(text), "")


def normalize_text(text: str | Column, composed: str | Column | None = None) -> Column:
    """Cleaned text; the placeholder stays as it is and replaces NULL and whatever cleans to nothing.

    ``composed`` is the NFC of the text where it is at hand already.
    """
    text = F.coalesce(_column(text).cast("string"), F.lit(""))
    cleaned = squash_spaces(keep_latin(nfc(text) if composed is None else composed))
    # The cleaned text holds no line breaks, so ^$ matches only the empty string.
    return F.when(_stripped_is(text, r"\.\.\."), PLACEHOLDER).otherwise(F.regexp_replace(cleaned, "^$", PLACEHOLDER))


def has_foreign(text: str | Column, composed: str | Column | None = None) -> Column:
    """True where the composed text has a letter whose name does not start with LATIN."""
    composed = nfc(F.coalesce(_column(text), F.lit(""))) if composed is None else _column(composed)
    return composed.rlike(character_classes()["find_foreign"])


def scrub(text: str | Column) -> Column:
    """NULL and texts that readers take for missing values become the placeholder; others stay unchanged."""
    text = _column(text)
    missing = _stripped_is(text, "(?i:" + "|".join(NA_LIKE) + ")")
    return F.when(text.isNull() | missing, PLACEHOLDER).otherwise(text)


def basename(path: str | Column) -> Column:
    """The part after the last ``/``."""
    return F.substring_index(_column(path), "/", -1)


def path_value(path: str | Column, name: str) -> Column:
    """The value after the last ``name=`` in a path, up to the next ``/``; the whole first part if absent."""
    return F.substring_index(F.substring_index(_column(path), f"{name}=", -1), "/", 1)


def shard_index(path: str | Column, marker: str = "manifest_") -> Column:
    """The text after the first ``marker`` up to the next dot; empty if the marker is absent."""
    quoted = "".join(c if c.isalnum() or c == "_" else "\\" + c for c in marker)
    return F.regexp_extract(_column(path), f"(?s){quoted}([^.]*)", 1)
