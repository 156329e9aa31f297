"""Token expressions: counting, splitting, left truncation, left padding.

The default tokenizer is a regular expression evaluated in the JVM: runs of
ASCII word characters, or any single other non-whitespace character. It is a
proxy for a subword tokenizer (each accented letter counts on its own); users
who need exact model token counts pass their own function (U2), which runs as
an Arrow-batched pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Written with explicit ASCII classes so that Java regex and RE2 (the SQL
# oracle) agree on every input, including the vertical tab.
TOKEN_PATTERN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_\t\n\x0B\f\r ]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(text, tokenizer: Callable | None = None, batched: bool = False) -> Column:
    """Number of tokens (G1). ``tokenizer`` is an optional user hook (U2):
    ``text -> ids``, or with ``batched=True`` ``list[text] -> list[ids]``."""
    if tokenizer is None:
        return F.regexp_count(_col(text), F.lit(TOKEN_PATTERN)).cast("bigint")
    return tokenizer_length_udf(tokenizer, batched)(_col(text))


def tokenizer_length_udf(tokenizer: Callable, batched: bool = False):
    """Wrap a tokenizer as a pandas UDF returning lengths. Spark hands it Arrow
    batches; a batched tokenizer is called once per batch."""

    @F.pandas_udf(T.LongType())
    def _len(s: pd.Series) -> pd.Series:
        if not batched:
            return s.map(lambda v: None if v is None else len(tokenizer(v))).astype("Int64")
        values = s.tolist()
        keep = [i for i, v in enumerate(values) if v is not None]
        lengths: list[int | None] = [None] * len(values)
        for i, ids in zip(keep, tokenizer([values[i] for i in keep]) if keep else []):
            lengths[i] = len(ids)
        return pd.Series(lengths, index=s.index, dtype="Int64")

    return _len


def tokens(text) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), 0)


def left_truncate(seq, n: int | Column) -> Column:
    """Keep the last ``n`` elements (K1). The start is clamped to 1 because
    ``slice`` with a start before the array returns an empty array."""
    s = _col(seq)
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(s, F.greatest(F.lit(1), F.size(s) - n + 1), n)


def left_pad(seq, width, pad) -> Column:
    """Pad on the left to ``width`` (K3)."""
    s = _col(seq)
    w = F.lit(width) if isinstance(width, int) else _col(width)
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(F.lit(0), w - F.size(s)).cast("int")), s)


def attention_mask(seq, width) -> Column:
    s = _col(seq)
    w = F.lit(width) if isinstance(width, int) else _col(width)
    return F.concat(F.array_repeat(F.lit(0), F.greatest(F.lit(0), w - F.size(s)).cast("int")),
                    F.array_repeat(F.lit(1), F.size(s)))


def round_up_even(n) -> Column:
    """((n + 1) div 2) * 2."""
    c = _col(n)
    return (c + 1 - F.pmod(c + 1, F.lit(2))).cast("bigint")
