"""Text helpers: words, addresses, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightwell.functions.bands import first_match

# The ASCII punctuation stripped from both ends of a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Category patterns, tried in this order on trimmed lower-case text.
CATEGORY_PATTERNS = (
    (r"^f$|f.m|w.m|female|woman", "Female"),
    (r"^m$|ma|m.l|male|man", "Male"),
)

# The exact spellings of the list-based variant.
CATEGORY_SPELLINGS = (
    (("f", "female", "woman"), "Female"),
    (("m", "male", "man"), "Male"),
)


# The characters that separate words, those of Unicode included.
WHITE_SPACE = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
#: The same characters as a pattern: the white space of Unicode, and four separators that are not part of it.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Without the white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def words(text: Column) -> Column:
    """Array of the white-space separated words; blank text gives one empty word."""
    return F.split(strip(text), BLANKS)


def clean_word(word: Column) -> Column:
    """Strip outer punctuation and lower; NULL unless only letters remain."""
    cleaned = F.lower(F.btrim(word, F.lit(PUNCTUATION)))
    return F.when(cleaned.rlike(r"^\p{L}+$"), cleaned)


def url_origin(url: Column) -> Column:
    """Scheme and host: everything before the third slash."""
    return F.substring_index(url, "/", 3)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def email_domain(email: Column) -> Column:
    text = F.lower(strip(email))
    return first_match(
        [(email.isNull() | (text == "") | (email == "None"), "No Email"),
         (F.contains(text, F.lit("@")), F.substring_index(text, "@", -1))],
        "Invalid Email")


def standard_category(text: Column, patterns=CATEGORY_PATTERNS, default: str = "Unknown") -> Column:
    """Category by regular expression; blank and NULL give the default."""
    cleaned = F.lower(strip(text))
    return first_match([(cleaned.rlike(pattern), label) for pattern, label in patterns], default)


def listed_category(text: Column, spellings=CATEGORY_SPELLINGS, default: str = "Unknown") -> Column:
    """Category by exact spelling: cheaper, and stricter than the patterns."""
    cleaned = F.lower(strip(text))
    return first_match([(cleaned.isin(*names), label) for names, label in spellings], default)


def is_blank(value: Column) -> Column:
    return value.isNull() | (strip(value.cast("string")) == "")
