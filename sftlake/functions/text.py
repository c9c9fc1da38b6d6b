"""Text normalisation (Python ``str.strip`` semantics) as JVM-side Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Python's str.strip() removes exactly these 29 code points:
#   U+0009 U+000A U+000B U+000C U+000D U+001C U+001D U+001E U+001F U+0020 U+0085 U+00A0
#   U+1680 U+2000 U+2001 U+2002 U+2003 U+2004 U+2005 U+2006 U+2007 U+2008 U+2009 U+200A
#   U+2028 U+2029 U+202F U+205F U+3000
# Spark's one-argument trim() handles only U+0020, so btrim() gets the whole set. btrim
# looks only at the two ends of a string; a regular expression would scan all of it.
STRIP_CHARS = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c) -> Column:
    """null -> '', otherwise the string with leading/trailing whitespace removed."""
    return F.btrim(F.coalesce(_col(c), F.lit("")), F.lit(STRIP_CHARS))


def kind_or_unknown(c) -> Column:
    """Normalised kind; an empty result becomes 'unknown'."""
    return F.coalesce(F.nullif(normalize_text(c), F.lit("")), F.lit("unknown"))
