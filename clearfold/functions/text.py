"""Text expressions, Column -> Column, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearfold.settings import PREVIEW_CHARS, REPLACEMENT_CHAR

# Every code point Python's str.strip() and \s treat as blank. Java's \s is ASCII only and
# (?U)\s leaves out 0x1c-0x1f, so the class is spelled out. All of them lie below U+3001.
BLANKS = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def _regex_class(chars: str) -> str:
    """Java class of the characters; one comparison rules out ordinary text beyond Latin-1."""

    def escaped(part: str) -> str:
        return "".join(f"\\x{{{ord(c):x}}}" for c in part)

    low = "".join(c for c in chars if ord(c) < 0x100)
    high = "".join(c for c in chars if ord(c) >= 0x100)
    return f"[{escaped(low)}[{escaped(high[0])}-{escaped(high[-1])}&&[{escaped(high)}]]]"


BLANK_RUN = _regex_class(BLANKS) + "++"

# Code points that can make a string differ from its NFC form: combining marks, code points
# newer than the JVM's tables, conjoining jamo, and the ranges that hold singleton or excluded
# compositions. Text without any of them, precomposed accents included, already is NFC.
# The leading range settles the common case, a code point below U+0300, with one comparison.
NFC_SUSPECT = (
    r"[\x{300}-\x{10ffff}&&[\p{M}\p{Cn}\x{374}\x{37e}\x{387}\x{900}-\x{fff}\x{1100}-\x{11ff}\x{1f70}-\x{1fff}"
    r"\x{2000}\x{2001}\x{2126}-\x{212b}\x{2329}\x{232a}\x{2adc}\x{f900}-\x{faff}"
    r"\x{fb1d}-\x{fb4f}\x{1d15e}-\x{1d1c0}\x{2f800}-\x{2fa1d}]]"
)

_WORD = r"([\p{L}\p{N}_]+)"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def nfc(c: Column) -> Column:
    """Unicode NFC. Only strings holding a suspect code point reach the normaliser.

    Spark has no NFC function; its own ICU library is called through java_method, which keeps
    the row in the JVM. A Python UDF would ship every text out and back.
    """
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False)
    )
    return F.when(c.rlike(NFC_SUSPECT), composed).otherwise(c)


def collapse_blanks(c: Column) -> Column:
    """Every run of blanks becomes one space; none is left at either end."""
    return F.trim(F.regexp_replace(c, BLANK_RUN, " "))


def strip_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip_blanks(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def has_replacement_char(c: Column) -> Column:
    return F.contains(c, F.lit(REPLACEMENT_CHAR))


def content_hash(source_type: Column, doc_id: Column, content: Column) -> Column:
    """First 16 hex digits of sha256 over source_type|doc_id|content."""
    parts = [text_or_empty(c) for c in (source_type, doc_id, content)]
    payload = F.concat_ws("|", *parts)
    return F.substring(F.sha2(payload, 256), 1, 16)


def preview(c: Column) -> Column:
    return F.substring(text_or_empty(c), 1, PREVIEW_CHARS)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores, in text order."""
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(_WORD), F.lit(1))
