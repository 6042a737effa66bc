"""Column expressions over text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python treats as whitespace.
WHITESPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The CJK block that counts as 1.5 characters per token.
CJK_CLASS = "[\u4e00-\u9fff]"
CHARS_PER_CJK_TOKEN = 1.5
CHARS_PER_OTHER_TOKEN = 4.0


def strip(col: Column) -> Column:
    """Both ends trimmed of every whitespace character, not only the blank."""
    return F.btrim(col, F.lit(WHITESPACE))


def normalise(col: Column) -> Column:
    """The form in which two texts are compared: trimmed and lower-cased."""
    return F.lower(strip(col))


def clean(col: Column) -> Column:
    """Each whitespace run becomes one blank; ends trimmed; NULL becomes ''."""
    others = WHITESPACE.replace(" ", "")
    # Mapping characters first leaves the regex only runs of blanks, not every blank.
    blanks = F.translate(col, others, " " * len(others))
    return F.coalesce(F.trim(F.regexp_replace(blanks, " {2,}", " ")), F.lit(""))


def truncate(col: Column, max_length: int = 200) -> Column:
    """Longer texts are cut so that, with '...', they have ``max_length`` characters."""
    if max_length < 3:
        raise ValueError("max_length must leave room for the three dots")
    cut = F.concat(F.substring(col, 1, max_length - 3), F.lit("..."))
    return F.when(F.length(col) <= max_length, col).otherwise(cut)


def token_estimate(col: Column) -> Column:
    """Rough token count: CJK and other characters weighted, whole part (BIGINT)."""
    other = F.length(F.regexp_replace(col, CJK_CLASS, ""))
    cjk = F.length(col) - other
    return (cjk / F.lit(CHARS_PER_CJK_TOKEN) + other / F.lit(CHARS_PER_OTHER_TOKEN)).cast("bigint")


def content_hash(col: Column) -> Column:
    """MD5 of the UTF-8 text, in hex."""
    return F.md5(col)


def hash_pick(n: int, seed: int, *keys: Column) -> Column:
    """A repeatable choice in 0..n-1 that depends only on seed and keys."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % n
