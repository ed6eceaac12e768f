"""Text cleaning and text flags as column expressions (CLN-1..12, PRJ-11..14, JS-6/7).

Everything except NFC (CLN-6) and full entity decoding is a JVM-side
expression inside whole-stage codegen. The two Python helpers are Arrow-batched
``pandas_udf``s and skip rows that cannot change (pure ASCII / no ``&``).
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values (cleaning rules).
MAX_TEXT_CHARS = 10000
MIN_WORDS = 3
EMOJI_RATIO_ABOVE = 0.8
URL_ONLY_PATTERN = r"^(https?://|www\.)\S+$"
MARKUP_PATTERN = r"<[^>]*>"
TIME_MARK_PATTERN = r"(^|\s)\d{1,2}:\d{2}(:\d{2})?(\s|$)"
TCO_LINK_PATTERN = r"https?://t\.co/\S+"
RETWEET_PREFIX_PATTERN = r"^RT @\w+:\s*"
# Code points counted as emoji: pictographs, symbols and dingbats, flags.
EMOJI_CLASS = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}]"
# Joiners and variation selectors: counted in neither numerator nor denominator.
JOINER_CLASS = r"[\x{200D}\x{FE0E}\x{FE0F}]"
# Zero-width and other invisible format/control characters (newline and tab kept).
INVISIBLE_CLASS = r"[\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}\x{007F}-\x{009F}\x{00AD}\x{061C}\x{200B}\x{200C}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FEFF}]"
# The five basic entities, decoded with `&amp;` last so `&amp;lt;` stays `&lt;`.
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def strip_ends(c: Column) -> Column:
    """CLN-1: leading/trailing whitespace including newlines (``trim`` only drops spaces)."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def collapse_ws(c: Column) -> Column:
    """CLN-2: inner runs of whitespace -> one space."""
    return F.regexp_replace(c, r"\s+", " ")


def null_if_empty(c: Column) -> Column:
    """CLN-3."""
    return F.nullif(c, F.lit(""))


def clean_ws(c: Column) -> Column:
    """CLN-1..3 in one expression."""
    return null_if_empty(strip_ends(collapse_ws(c)))


def drop_invisible(c: Column) -> Column:
    """CLN-7: zero-width and control characters; U+200D stays (emoji joiner, CLN-8)."""
    return F.regexp_replace(c, INVISIBLE_CLASS, "")


def decode_basic_entities(c: Column) -> Column:
    """CLN-4 for the five basic entities, JVM-side."""
    for ent, ch in BASIC_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


@F.pandas_udf(StringType())
def _unescape_all(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def decode_entities(c: Column) -> Column:
    """CLN-4, every named and numeric entity. Rows without ``&`` go to Python as
    NULL (a UDF below a ``when`` would get them whole)."""
    return F.coalesce(_unescape_all(F.when(F.instr(c, "&") > 0, c)), c)


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(c: Column) -> Column:
    """CLN-6: Unicode NFC; ASCII-only rows are NFC already and go to Python as NULL."""
    return F.coalesce(_nfc(F.when(c.rlike(r"[^\x{0000}-\x{007F}]"), c)), c)


def truncate(c: Column, n: int = MAX_TEXT_CHARS) -> Column:
    """CLN-5: first ``n`` characters."""
    return F.left(c, F.lit(n))


def was_truncated(c: Column, n: int = MAX_TEXT_CHARS) -> Column:
    return F.coalesce(F.length(c) > F.lit(n), F.lit(False))


def strip_markup(c: Column) -> Column:
    """CLN-10: tags -> one space, then whitespace rules."""
    return clean_ws(F.regexp_replace(c, MARKUP_PATTERN, " "))


def strip_time_marks(c: Column) -> Column:
    """CLN-11: standalone ``m:ss``/``h:mm:ss`` marks."""
    return F.regexp_replace(c, TIME_MARK_PATTERN, " ")


def strip_tco_links(c: Column) -> Column:
    return F.regexp_replace(c, TCO_LINK_PATTERN, " ")


def strip_retweet_prefix(c: Column) -> Column:
    return F.regexp_replace(c, RETWEET_PREFIX_PATTERN, "")


def untruncated_text(c: Column, normalise: bool = True, entities: bool = True) -> Column:
    """The text rules in order, without the last: entities, NFC, invisibles,
    whitespace, empty -> NULL."""
    if entities:
        c = decode_entities(c)
    if normalise:
        c = nfc(c)
    return clean_ws(drop_invisible(c))


def clean_text(c: Column, normalise: bool = True, entities: bool = True) -> Column:
    """The full text rule set: ``untruncated_text``, then truncation."""
    return truncate(untruncated_text(c, normalise, entities))


def text_fallback(message: Column, story: Column) -> Column:
    """PRJ-11: message, else story, when message is NULL or blank."""
    return F.coalesce(clean_ws(message), clean_ws(story))


def is_share(message: Column, story: Column) -> Column:
    """PRJ-13: no usable message but a story."""
    return clean_ws(message).isNull() & clean_ws(story).isNotNull()


def has_text(cleaned: Column) -> Column:
    """PRJ-14."""
    return F.coalesce(F.length(cleaned) > 0, F.lit(False))


def word_count(cleaned: Column) -> Column:
    return F.when(cleaned.isNull(), F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def too_short(cleaned: Column, min_words: int = MIN_WORDS) -> Column:
    """JS-7: fewer than ``min_words`` words after whitespace collapse."""
    return word_count(cleaned) < F.lit(min_words)


def url_only(cleaned: Column) -> Column:
    return F.coalesce(cleaned.rlike(URL_ONLY_PATTERN), F.lit(False))


def emoji_count(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, EMOJI_CLASS, ""))


def counted_chars(c: Column) -> Column:
    """Code points other than whitespace, joiners and variation selectors."""
    return F.length(F.regexp_replace(F.regexp_replace(c, r"\s", ""), JOINER_CLASS, ""))


def high_emoji_ratio(cleaned: Column, above: float = EMOJI_RATIO_ABOVE) -> Column:
    """JS-7: emoji / counted characters > ``above`` (exact integer comparison)."""
    num, den = emoji_count(cleaned), counted_chars(cleaned)
    # num/den > 0.8  <=>  10*num > 8*den, kept in integers
    scale = 1000
    return F.coalesce((den > 0) & (num * F.lit(scale) > den * F.lit(int(round(above * scale)))), F.lit(False))


def flags_csv(flags: dict[str, Column]) -> Column:
    """JS-6: comma-separated names of the true flags, NULL when none."""
    arr = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in flags.items()]))
    return F.nullif(F.concat_ws(",", arr), F.lit(""))


def repair_latin1_mojibake(c: Column) -> Column:
    """CLN-9 (limited): text that was UTF-8 read as Latin-1 (``Ã©`` for ``é``)
    is re-encoded and decoded once; anything that does not round-trip stays."""
    suspicious = c.rlike("[ÂÃ][\u0080-¿]") & c.rlike(r"^[\x{0000}-\x{00FF}]*$")
    # Latin-1 bytes read back as UTF-8; binary -> string does not validate, the
    # check does (NULL when the bytes are not UTF-8, and then the text stays)
    fixed = F.try_validate_utf8(F.when(suspicious, F.encode(c, "ISO-8859-1").cast("string")))
    return F.coalesce(fixed, c)
