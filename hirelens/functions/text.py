"""Text expressions shared by the parsers."""

import sys
import unicodedata

from pyspark.sql import Column, functions as F

# Unicode white space as the inside of a character class.
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
# The same characters one after another.
WS_CHARS = "".join(c for c in map(chr, range(0x10000)) if "\t" <= c <= "\r" or "\x1c" <= c <= "\x1f" or c == "\x85" or unicodedata.category(c)[0] == "Z")

# A word is a run of letters, digits and underscores.  Words are one token where they are joined by ``&``
# (``R&D``), by a hyphen beside a digit (``S3-compatible``), by a dot (``Node.js``; but not where a small letter ends
# a sentence and a capital begins the next), or by dots after single letters (``R.N.``, ``H.R``); a token has up to ten
# such joins.  A dot before a word belongs to it where nothing stands before the dot (``.NET``), and plus and number
# signs after it do too (``C++``, ``C#``), but for a single plus between two words.  Every other visible
# character is a token of its own.
_WORD = r"[\p{L}\p{N}_]"
_DOTTED = rf"\p{{L}}(?:\.\p{{L}}){{1,10}}(?:\.|{_WORD}*)"
_JOIN = r"(?:&|(?<=\p{N})-|-(?=\p{N})|(?<!\p{Ll})\.|\.(?!\p{Lu}))"
_LEAD = r"(?<![\p{L}\p{N}_.)\]])\.(?=\p{L})"
_JOINED = rf"(?:{_LEAD})?{_WORD}+(?:{_JOIN}{_WORD}+){{0,10}}(?:\+{{2,}}|\+(?!{_WORD})|#+)?"
BARE_TOKEN = rf"(?:{_DOTTED}|{_JOINED}|[^{WS}\p{{L}}\p{{N}}_])"
# The same with the white space in front of it.
TOKEN = rf"[{WS}]*{BARE_TOKEN}"

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


# Decimal digits of all other scripts, and the ASCII digit of each.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as ASCII digits."""
    turned = F.translate(text, "".join(_DIGITS), _ASCII_DIGITS)
    return F.when(text.rlike(r"[^\x00-\x7F]"), turned).otherwise(text)


def strip(text: Column) -> Column:
    """Remove white space (not only blanks) at both ends."""
    return F.regexp_replace(text, rf"^[{WS}]+|[{WS}]+$", "")


def squash_ws(text: Column) -> Column:
    """Strip, and turn every inner run of white space into one blank."""
    return F.regexp_replace(strip(text), rf"[{WS}]+", " ")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower the rest.

    Unlike plain ``initcap`` a run also starts after an apostrophe, a digit or any
    other non-letter: ``o'fallon`` gives ``O'Fallon``.
    """
    runs = F.regexp_extract_all(text, F.lit(rf"[{_CASED}]+[^{_CASED}]*|[^{_CASED}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def place_name(city: Column, state: Column, country: Column) -> Column:
    """The non-empty parts joined by a comma and a blank."""
    return F.concat_ws(", ", *[F.nullif(c, F.lit("")) for c in (city, state, country)])


def place_label(city: Column, state: Column, country: Column) -> Column:
    """Map label: parts joined even when missing, commas and blanks cut at both ends."""
    joined = F.concat_ws(", ", *[F.coalesce(c, F.lit("")) for c in (city, state, country)])
    cut = F.trim(joined, F.lit(", "))
    return F.when(cut == "", "Unknown").otherwise(cut)


def skill_name(norm: str = "skill_norm", raw: str = "skill_raw") -> Column:
    """Display name of a skill: the normalized form, else the raw one."""
    return F.coalesce(F.col(norm), F.col(raw))
