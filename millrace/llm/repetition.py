"""Quality rules by repetition coverage.

Every text becomes an array of word numbers.  Rolling hashes over that array, one per n-gram
length, show which n-grams recur; the characters of the words that recurring n-grams cover,
and those of recurring lines, are set against the characters of all words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from millrace.llm.common import map_slices, mix64

SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Largest allowed share of a text's word characters inside n-grams (by length in words) that
#: recur, and inside lines that repeat an earlier one.
MAX_NGRAM_SHARE = {5: 0.40, 6: 0.38, 8: 0.35, 10: 0.32}
MAX_LINE_SHARE = 0.30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, dup_ngram_share double, base_failed boolean, kept boolean"
)


def covered(codes: np.ndarray, n: int, words: int) -> np.ndarray:
    """Mask of the words inside an n-gram whose code occurs at least twice."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(codes), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    step = np.zeros(words + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n-gram of word numbers: a polynomial over mixed numbers, modulo 2**64."""
    mixed = mix64(ids.astype(np.uint64) + np.uint64(1))
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + mixed[k : len(ids) - n + 1 + k]
    return mix64(out)


def measure(text: str | None) -> tuple:
    """The columns of SCHEMA, without doc_id, of one text.  Null and empty texts have no word and fail."""
    text = text if isinstance(text, str) else ""
    words = WORD.findall(text)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    word_chars = int(lengths.sum())
    symbols = len(SYMBOLS.findall(text))
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(map(len, WORD.findall(line)))
        elif WORD.search(line):
            seen.add(line)
    repeat_words, share, over = 0, 0.0, dup_line_chars > MAX_LINE_SHARE * word_chars
    if n >= 3:
        numbers: dict[str, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        if len(numbers) < 1 << 21:
            triples = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        else:  # a vocabulary too large for one code: number the pairs first
            pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
            triples = np.unique(pairs[:-1].astype(np.int64) * (len(numbers) + 1) + ids[2:], return_inverse=True)[1]
        repeat_words = int(covered(triples, 3, n).sum())
        if repeat_words:
            for size, most in MAX_NGRAM_SHARE.items():
                if n < size:
                    break
                mask = covered(rolling(ids, size), size, n)
                part = float(lengths[mask].sum()) / word_chars
                share = max(share, part)
                over |= part > most
                if not mask.any():
                    break
    failed = n < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PERCENT * n
    return n, word_chars, symbols, dup_lines, repeat_words, dup_line_chars, share, failed, not failed and not over


@F.pandas_udf(BooleanType())
def passes(texts: pd.Series) -> pd.Series:
    """The verdict alone, as a column: never null, false for null and empty texts.

    It reads the text only, so that ids, repeated rows and other columns play no part; an empty table gives no value.
    """
    return pd.Series([measure(t)[-1] for t in texts], dtype=bool)


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict of every row: one output row per input row, no shuffle.

    Null and empty texts: all counts zero, base_failed.  A null id stays null; ids of any size are exact.
    Repeated rows give repeated results.  A very long text is measured whole, in memory that grows with its
    words.  A share equal to its limit passes.  An empty table gives an empty result.  Other columns,
    whatever their names, are neither read nor kept.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        for pdf in batches:
            rows = [measure(t) for t in pdf["text"]]
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", pdf["doc_id"])
            yield out

    return map_slices(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, SCHEMA)
