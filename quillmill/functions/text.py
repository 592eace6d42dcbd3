"""Text column builders. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
CHARS_PER_TOKEN = 4

# Unicode white space: what Java's \s leaves out is listed by code and by category
_WHITESPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
_VISIBLE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
_WORD = r"[\p{L}\p{N}]+"


def collapse_whitespace(text: Column) -> Column:
    """Every run of white space becomes one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, _WHITESPACE, " "))


def is_blank(text: Column) -> Column:
    """Whether there is white space only; the search ends at the first other character."""
    return ~F.rlike(text, F.lit(_VISIBLE))


def char_slice(text: Column, start: int, stop: int) -> Column:
    """Characters ``start`` to ``stop`` (exclusive, from 0), counted as code points."""
    return F.substring(text, start + 1, stop - start)


def char_chunks(text: Column, size: int) -> Column:
    """The whole text as an array of pieces of ``size`` characters.

    One regex sweep is linear in the text; a substring per piece would start from the
    first byte each time.
    """
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def run_of_letters(least: int) -> str:
    """The pattern that finds a word of ``least`` or more letters and digits."""
    return r"[\p{L}\p{N}]{%d}" % max(least, 1)


def token_estimate(text: Column) -> Column:
    """Model tokens, at four characters each."""
    return F.ceil(F.length(text) / F.lit(CHARS_PER_TOKEN))


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def strip_html(html: Column) -> Column:
    """Visible text of a web page: scripts, styles, comments and tags out, main entities decoded."""
    text = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse_whitespace(text)


def sentences(text: Column) -> Column:
    """Runs up to and with their closing marks, trimmed; blank ones left out."""
    runs = F.regexp_extract_all(text, F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    return F.filter(F.transform(runs, collapse_whitespace), lambda s: F.length(s) > 0)
