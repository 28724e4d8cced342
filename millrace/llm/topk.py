"""Exact top-k inner products by block-at-a-time pruning.

The vectors of a batch are ordered by median splits and cut into ranges of ``block`` documents.  A block
keeps its rows (the forward index) and the largest and smallest component of each term.  For a query the
sum over terms of the larger of ``q * max`` and ``q * min`` bounds every score in a block.  Blocks are
visited by falling bound, and a query stops once a bound falls below its k-th score so far.

Blocks are built once, written with their bounds and forward indexes, and so are the queries, in chunks of
bounded size.  One stage then runs a grid of query chunk and group of index files; a task reads its files
one after the other and carries each query's k best, whose last prunes the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, written

BLOCK = 64
#: Queries in a chunk, and vectors in a row of the index.
CHUNK = 2048
INDEXED = 4096


def order_by_splits(x: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """An order in which ranges of ``block`` rows are alike: split at the median of the widest component."""
    out: list[np.ndarray] = []
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= block:
            out.append(rows)
            continue
        part = x[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        half = -(-len(rows) // (2 * block)) * block
        cut = np.argsort(part[:, axis], kind="stable")
        todo += [rows[cut[half:]], rows[cut[:half]]]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Blocks:
    """Blocks of integer vectors of one length, with their forward indexes and term bounds."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, block: int = BLOCK, ordered: bool = False) -> None:
        order = slice(None) if ordered else order_by_splits(x, block)
        self.ids, self.x = ids[order], x[order]
        self.starts = np.arange(0, len(ids), block)
        self.stops = np.append(self.starts[1:], len(ids))
        self.high = np.maximum.reduceat(self.x, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.x, self.starts, axis=0)
        self.scored = 0

    def search(self, own: int, q: np.ndarray, bounds: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge this index into the best (ids, scores) so far of query vector q, whose own id is left out."""
        order = np.argsort(-bounds, kind="stable")
        at, step = 0, 2
        while at < len(order):
            kth = scores[k - 1] if len(scores) >= k else -np.inf
            part = order[at : at + step]
            part = part[bounds[part] >= kth]
            if not len(part):
                break
            rows = np.concatenate([np.arange(self.starts[b], self.stops[b]) for b in part])
            found = self.x[rows] @ q
            self.scored += len(rows)
            keep = (found >= kth) & (self.ids[rows] != own)
            ids, scores = best_of(np.concatenate((ids, self.ids[rows[keep]])), np.concatenate((scores, found[keep])), k)
            at += step
            step = min(step * 2, 64)
        return ids, scores


def matrices(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors as doubles) by vector length."""
    ids, x = pdf["vec_id"].to_numpy(np.int64), pdf["x"]
    sizes = np.fromiter(map(len, x), np.int64, len(x))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield ids[at], np.stack(x.iloc[at].to_numpy()).astype(np.float64) if size else np.zeros((len(at), 0))


def packed(rows: DataFrame, at_once: int, order: int | None) -> DataFrame:
    """(dims, ids, x): vectors of one length, at most ``at_once`` in a row, as bytes; in the order of blocks if one is given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ids, x in matrices(pdf):
                if order:
                    by = order_by_splits(x, order)
                    ids, x = ids[by], x[by]
                out.append((x.shape[1], ids.tobytes(), x.tobytes()))
            yield pd.DataFrame(out, columns=["dims", "ids", "x"])

    return map_slices(rows, run, PACKED, rows=at_once)


PACKED = "dims int, ids binary, x binary"


def unpacked(path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of each row of a file of ``packed``, a few at a time."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    disk, at = fs.FileSystem.from_uri(path)
    with disk.open_input_file(at) as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=4):
            for dims, ids, x in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys = np.frombuffer(ids, np.int64)
                yield keys, np.frombuffer(x, np.float64).reshape(len(keys), dims)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id, x: floor(scale * component) of the vectors that are whole and finite."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ints = F.transform(x, lambda v: F.floor(v * scale).cast("double"))
    return vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("x"))


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible by ``every``.

    Scores are exact integers as long as they stay below 2**53.  Ties go to the smaller id; all rows with
    the query's id are its own and left out; repeated ids count as many candidates, and of the vectors of a
    repeated query id the least one (in the order of its components) asks.  Vectors that are null or hold
    null or non-finite components, and null ids, take no part.  Only vectors of equal length are compared,
    however long; those without components score 0.  An empty table gives an empty result; other columns,
    whatever their names, are not read.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vec_col, scale)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    index = written(packed(rows, INDEXED, block), "index")[0].inputFiles()
    asking = written(packed(asked, chunk, None), "queries")[0].inputFiles()
    if not index or not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    groups = min(len(index), max(1, -(-4 * spark.sparkContext.defaultParallelism // len(asking))))
    cells = [(q, index[g::groups]) for q in asking for g in range(groups)]  # names of files only
    grid = spark.createDataFrame(cells, "asking string, index array<string>").repartition(len(cells), "asking", F.col("index")[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.empty(0, np.int64), np.empty(0)
        for pdf in batches:
            for asked_in, files in zip(pdf["asking"], pdf["index"], strict=True):
                sent = list(unpacked(asked_in))
                best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for path in files:
                    for ids, x in unpacked(path):
                        blocks = Blocks(ids, x, block, ordered=True)
                        for own, q in sent:
                            if q.shape[1] == x.shape[1]:
                                bounds = np.maximum(q, 0) @ blocks.high.T + np.minimum(q, 0) @ blocks.low.T
                                for i, o in enumerate(own.tolist()):
                                    best[o] = blocks.search(o, q[i], bounds[i], *best.get(o, none), k)
                out = [(o, i, s) for o, (ids, scores) in best.items() for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})

    found = map_slices(grid, run, "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
