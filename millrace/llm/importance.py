"""Quality classifier by importance resampling.

Two generative models over hashed n-grams of bytes share one table of buckets: one for the target
(labelled good texts), one for the raw corpus.  A text's log weight is the sum of the log ratios of
its n-grams' probabilities.  Texts are then sampled without replacement, in proportion to tempered
weights, by Gumbel top-k: the k largest of ``log weight / temperature + Gumbel noise``.

The raw counts cover every document.  The target counts come from a bounded sample of labelled good rows
(``max_labelled``); no label of a bad row is ever read.  k is the number of texts of the whole corpus whose
weight reaches what the share ``keep`` of the target has, so it grows with the corpus.  It says how many
texts stay; which ones, the draw says: near the border the noise decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import chunks, mix64, stored, utf8

ORDERS = (3, 4, 5)
BUCKETS = 1 << 16
PIECE = 1 << 20
MAX_LABELLED = 20_000
#: The share of the target whose weights k is taken from, and what log weights are divided by before the noise.
KEEP, TEMPERATURE = 0.995, 4.0


def buckets(blobs: list[bytes], orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram order: the bucket of each n-gram, and how many of them each blob has, in order.

    A blob of b bytes has max(0, b - n + 1) n-grams of order n; n-grams never cross blobs.
    """
    data = np.frombuffer(b"".join(blobs), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    ends = np.cumsum(sizes)
    code, width = data, 1
    for n in sorted(orders):
        while width < n:
            width += 1
            code = (code[:-1] << np.uint64(8)) | data[width - 1 :] if len(code) else code
        counts = np.maximum(0, sizes - n + 1)
        keep = np.ones(len(code), bool)
        for k in range(1, n):  # starts that would reach into the next blob
            at = ends - k
            at = at[(at >= 0) & (at < len(code))]
            keep[at] = False
        yield (mix64(code[keep] * np.uint64(8) + np.uint64(n)) >> np.uint64(48)).astype(np.uint16), counts


def model_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of the target rows (column ``target``) and of all rows.

    A task sums in numpy; its two tables go on in slices, which are added up in two levels, so neither a
    task nor the driver gets more than a fixed number of bytes for each of a bounded number of parts.
    """
    slices, width = 8, BUCKETS // 8

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, BUCKETS), np.int64)
        part = 0
        for pdf in batches:
            blobs, target = utf8(pdf["text"]), pdf["target"].to_numpy(bool)
            part = int(pdf["part"].iloc[0]) if len(pdf) else part
            for a, b in chunks(blobs, PIECE):
                for found, sizes in buckets(blobs[a:b]):
                    total[1] += np.bincount(found, minlength=BUCKETS)
                    if target[a:b].any():
                        total[0] += np.bincount(found[np.repeat(target[a:b], sizes)], minlength=BUCKETS)
        if total.any():
            yield pd.DataFrame([(s, part, total[:, s * width : (s + 1) * width].tobytes()) for s in range(slices)], columns=["slice", "part", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(c, np.int64) for c in pdf["counts"]), np.zeros(2 * width, np.int64))
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": [0], "counts": [total.tobytes()]})

    schema = "slice int, part int, counts binary"
    parts = docs.select("text", "target", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")).mapInPandas(count, schema)
    sums = parts.groupBy("slice", "part").applyInPandas(add, schema).groupBy("slice").applyInPandas(add, schema).collect()
    out = np.zeros((2, BUCKETS), np.int64)
    for r in sums:
        out[:, r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], np.int64).reshape(2, width)
    return out[0], out[1]


def log_ratios(target: np.ndarray, raw: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p = (target + smooth) / (target.sum() + smooth * len(target))
    q = (raw + smooth) / (raw.sum() + smooth * len(raw))
    return np.log(p / q)


def log_weight(spark: SparkSession, ratios: np.ndarray) -> Callable[[str], Column]:
    """A function of a text column: struct of n_grams and log_weight; a null, empty or too short text weighs 0."""
    table = spark.sparkContext.broadcast(ratios)  # 65,536 doubles, whatever the corpus

    @F.pandas_udf("n_grams long, log_weight double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            blobs = utf8(texts)
            weight, grams = np.zeros(len(blobs)), np.zeros(len(blobs), np.int64)
            for a, b in chunks(blobs, PIECE):
                for found, sizes in buckets(blobs[a:b]):
                    sums = np.concatenate(([0.0], np.cumsum(table.value[found])))
                    ends = np.cumsum(sizes)
                    weight[a:b] += sums[ends] - sums[ends - sizes]
                    grams[a:b] += sizes
            yield pd.DataFrame({"n_grams": grams, "log_weight": np.round(weight, 6)})

    return score


def top_k_threshold(keys: DataFrame, k: int, bins: int = 4096) -> tuple[float, int]:
    """(key, id) of the k-th row by key descending, then id ascending: rounds of histograms, no global sort.

    Each round aggregates counts in at most ``bins`` bins before it shuffles and narrows the range to one
    bin, until the bin's rows fit one; equal keys are parted by the same search over ids.
    """

    def search(df: DataFrame, column: str, k: int) -> tuple[float, int]:
        """The k-th smallest value of the column, and how many rows are below it."""
        low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
        below = 0
        while low < high:
            step = (high - low) / bins
            at = F.least(F.lit(bins - 1), F.floor((F.col(column) - F.lit(low)) / F.lit(step)).cast("long")) if step > 0 else F.lit(0)
            inside = df.where((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
            rows = sorted(inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect())
            for _, n, lo, hi in rows:
                if below + n >= k:
                    if (lo, hi) == (low, high) and len(rows) == 1 and n > 1 and step == 0:
                        return low, below
                    low, high = lo, hi
                    break
                below += n
        return low, below

    key, above = search(keys.select((-F.col("key")).alias("minus")), "minus", k)
    ties = keys.where(F.col("key") == F.lit(-key)).select("doc_id")
    last, _ = search(ties, "doc_id", k - above)
    return -key, int(last)


class Sampler:
    """A fitted model and the k-th key: which rows of the documents it was fitted on stay."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep: float = KEEP, temperature: float = TEMPERATURE, evidence: int = 256, max_labelled: int = MAX_LABELLED, seed: int = 17) -> None:
        spark = docs.sparkSession
        self.temperature, self.evidence, self.seed = temperature, evidence, seed
        rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).where("doc_id is not null")
        good = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("good")).where("doc_id is not null and good = 1").select("doc_id").distinct()
        sample = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect()
        known = spark.createDataFrame([(r[0], 1) for r in sample], "doc_id long, good int")  # at most max_labelled rows
        target, raw = model_counts(rows.join(F.broadcast(known), "doc_id", "left").select("text", F.coalesce(F.col("good") == 1, F.lit(False)).alias("target")))
        self.weigh = log_weight(spark, log_ratios(target, raw) if target.any() else np.zeros(BUCKETS))
        parts = self.columns(F.col("doc_id"), F.col("weight"))
        self.scored = stored(rows.select("doc_id", self.weigh("text").alias("weight")).select("doc_id", "weight.*", *(c.alias(n) for n, c in parts.items())), "weights")
        aims = np.sort(self.scored.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.max("value").alias("value")).toPandas()["value"].to_numpy(float))
        cut = float(np.quantile(aims, 1 - keep, method="lower")) if len(aims) else -np.inf
        total, k = self.scored.agg(F.count("*"), F.count_if(F.col("value") >= F.lit(float(cut)))).first()
        self.last = None if k == total else (np.inf, 0) if k == 0 else top_k_threshold(self.scored, k)

    def columns(self, doc_id: Column, weight: Column) -> dict[str, Column]:
        value = weight["log_weight"] * F.least(F.lit(1.0), F.lit(float(self.evidence)) / F.greatest(F.lit(1), weight["n_grams"]))
        uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(self.seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return {"value": value, "key": F.round(value / self.temperature - F.log(-F.log(uniform)), 9)}

    def kept(self, doc_id: Column, key: Column) -> Column:
        if self.last is None:
            return F.lit(True)
        least, last = self.last
        return (key > F.lit(least)) | ((key == F.lit(least)) & (doc_id <= F.lit(last)))


def resample(docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """doc_id, n_grams, log_weight, key, kept of every row with an id.

    ``key`` is the log weight, scaled to at most ``evidence`` n-grams so that length alone doesn't decide
    and divided by ``temperature``, plus Gumbel noise that depends on the id and the seed only.
    Null and empty texts weigh 0.  A null id is left out; ids of any size are exact.  Repeated rows get equal
    keys and are kept or go together; of other equal keys the smaller id is kept.  A very long text is
    weighed whole.  Without a good label every row is kept.  An empty table gives an empty result; other
    columns, whatever their names, are not read.
    """
    sampler = Sampler(docs, labels, **options)
    return sampler.scored.select("doc_id", "n_grams", "log_weight", "key", sampler.kept(F.col("doc_id"), F.col("key")).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows that ``resample`` keeps, with all their columns, by a second scoring instead of a shuffle.

    Rows without an id stay.  Null and empty, repeated, tied and very long rows fare as in ``resample``; an empty
    table gives an empty result; columns of any name stay as they are.
    """
    sampler = Sampler(docs, labels, id_col, text_col, **options)
    doc_id = docs[id_col].cast("long")
    key = sampler.columns(doc_id, sampler.weigh(docs[text_col]))["key"]
    return docs.where(doc_id.isNull() | sampler.kept(doc_id, key))
