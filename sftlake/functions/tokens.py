"""Bundled tokenizer and token-sequence functions (JVM-side).

The bundled tokenizer lower-cases, then emits every Han code point as its own token and
every maximal run of other non-whitespace characters as one token. A sub-word tokenizer can
be plugged in instead through ``plugin_tokenize`` (Arrow-batched pandas UDF).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace for token boundaries is the ASCII set \t \n \x0b \x0c \r and space.
TOKEN_PATTERN = r"(\p{IsHan}|[^\x{9}-\x{d}\x{20}\p{IsHan}]+)"
PY_TOKEN_PATTERN = r"(\p{Han}|[^\x09-\x0d\x20\p{Han}]+)"  # same rule for the `regex` module
DEFAULT_MAX_LENGTH = 1024


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), 1)


def truncate(tokens, max_length: int = DEFAULT_MAX_LENGTH) -> Column:
    return F.slice(_col(tokens), 1, max_length)


def valid_token_count(n_tokens, max_length: int = DEFAULT_MAX_LENGTH) -> Column:
    """Scored positions of a causal LM: all but the first of the truncated sequence."""
    return F.greatest(F.least(_col(n_tokens), F.lit(max_length)) - 1, F.lit(0))


def py_tokenize(text: str) -> list[str]:
    """Python twin of ``tokenize`` (used inside plug-ins)."""
    import regex

    return regex.findall(PY_TOKEN_PATTERN, text.lower())


def plugin_tokenize(fn: Callable[[list[str]], list[list[str]]]):
    """Wrap a batch tokenizer ``list[str] -> list[list[str]]`` as a pandas UDF."""

    @F.pandas_udf("array<string>")
    def _tok(s: pd.Series) -> pd.Series:
        return pd.Series(fn(s.fillna("").tolist()))

    return _tok
