"""The few functions without a built-in form, as Arrow-batched UDFs; equal arguments of a worker are computed once."""

from __future__ import annotations

import ast
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType


@lru_cache(1 << 16)
def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro similarity plus a tenth of the rest for each of up to four equal leading characters, above 0.7."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    left: list[str] = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                left.append(ch)
                break
    if not left:
        return 0.0
    right = [ch for ch, unused in zip(b, free, strict=True) if not unused]
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))  # noqa: B905
    return jaro + same * 0.1 * (1 - jaro)


def jaro_winkler(a: Column, b: Column) -> Column:
    @F.pandas_udf(DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else jaro_winkler_of(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.when(a.isNotNull() & b.isNotNull(), run(a, b))


def alias_list(text: str | None) -> list[str]:
    """The items of a Python list literal; another text is one item; blank items go."""
    text = (text or "").strip()
    if not text:
        return []
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return [text]
    items = value if isinstance(value, list) else [text]
    return [s for s in (str(i).strip() for i in items if i is not None) if s]


def parse_alias_list(x: Column) -> Column:
    """Never null.  Only texts in brackets go through Python."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(alias_list)

    bare = F.trim(x)
    return F.when(bare.isNull() | (bare == "") | (bare == "[]"), F.array().cast("array<string>")).when(bare.startswith("["), run(x)).otherwise(F.array(bare))
