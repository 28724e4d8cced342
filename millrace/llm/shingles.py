"""Near-duplicates by exact Jaccard similarity of word shingles, among candidates of two kinds.

1. Texts with the same set of shingles are one class; its key is a hash of the set.
2. A class has a SimHash fingerprint of its set.  A self-join of binary tries (``simhash.py``) links classes whose
   fingerprints differ in at most RADIUS bits.
3. Most pairs at the threshold lie beyond any radius that the tries can carry.  For these, a class has ``BANDS`` hashes of ``ROWS`` least hashes each.  Classes that share one are linked to the least
   key of the bucket.  Stars of the links of both kinds are contracted to groups.  A pair at 0.8 shares a bucket with
   probability 1 - (1 - 0.8**ROWS)**BANDS = 0.99994, a more similar one with a higher one.
4. A group is cut into chunks of at most ``BLOCK`` classes.  A task compares the shingles of a chunk exactly and gives
   a spanning forest of the pairs at or above the threshold.
5. In a group of several chunks, the classes outside its largest component meet all its chunks once more,
   so that every pair of a group is compared unless it is linked already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, mix64, stored
from millrace.llm.simhash import HELD, LOWER, SHIFTS, keep_representatives, links, star_components

WIDTH = 5
#: The threshold is SHARE[0] / SHARE[1], in whole numbers.
SHARE = (4, 5)
BANDS, ROWS = 32, 6
#: Bits in which fingerprints that the tries link may differ.
RADIUS = 3
#: Classes in a task.
BLOCK = 128
#: Shingles that are permuted at once: they stay in the processor's cache.
AT_ONCE = 1 << 15

_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
FLIPS = _SEEDS[: BANDS * ROWS].astype(np.uint32)
FACTORS = _SEEDS[BANDS * ROWS :].astype(np.uint32) | np.uint32(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words; of all words if there are fewer, none if there is no word."""
    data = text.encode("utf-8", "replace") if isinstance(text, str) else b""
    words = data.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n))


def key_of(found: np.ndarray) -> int:
    """Signed 64-bit hash of a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), 7)).view(np.int64))


def fingerprint(found: np.ndarray) -> int:
    """Signed SimHash fingerprint of a set of shingles: a bit is set if more than half of the hashes have it; 0 for none."""
    bits = np.unpackbits(found.view(np.uint8).reshape(len(found), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int((np.uint64(1) << SHIFTS[2 * bits > len(found)]).sum(dtype=np.uint64).view(np.int64))


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """The band hashes (BANDS columns) of sets that are not empty."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sets), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = mix64(h ^ np.minimum.reduceat((flat ^ FLIPS[k]) * FACTORS[k], starts).astype(np.uint64))
        out[:, band] = h
    return out.view(np.int64)


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, fingerprint and bands of every row with an id; texts without words have no band and are one class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, prints = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            sig: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pdf)
            at: list[int] = []
            sets: list[np.ndarray] = []
            held = 0
            for i, text in enumerate(pdf["text"]):
                found = shingles(text)
                keys[i], prints[i] = key_of(found), fingerprint(found)
                if len(found):
                    at.append(i)
                    sets.append(found)
                    held += len(found)
                if at and (held >= AT_ONCE or i == len(pdf) - 1):
                    for j, row in zip(at, bands(sets), strict=True):
                        sig[j] = row
                    at, sets, held = [], [], 0
            if at:
                for j, row in zip(at, bands(sets), strict=True):
                    sig[j] = row
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "key": keys, "fp": prints, "bands": sig})

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).where("doc_id is not null")
    return map_slices(rows, run, "doc_id long, key long, fp long, bands array<long>")


def forest(keys: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """(a, b), a > b: edges of stars of the components that the pairs at or above the threshold make.

    Breadth first: a class is compared with those that no one has reached yet, so that a cluster whose
    members are all alike takes one pass.
    """
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    owned = [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    marked = np.zeros(int(flat.max()) + 1, np.int64)
    left = np.arange(len(sets))
    out = []
    num, den = SHARE
    while len(left):
        members, left, waiting = [int(left[0])], left[1:], [int(left[0])]
        while waiting and len(left):
            u = waiting.pop()
            marked[owned[u]] = 1
            common = np.array([int(marked[owned[v]].sum()) if num * max(sizes[u], sizes[v]) <= den * min(sizes[u], sizes[v]) else 0 for v in left.tolist()])
            marked[owned[u]] = 0
            near = (num + den) * common >= num * (sizes[u] + sizes[left])
            reached = left[near].tolist()
            members += reached
            waiting += reached
            left = left[~near]
        low = min(keys[m] for m in members)
        out += [(keys[m], low) for m in members if keys[m] != low]
    return out


def compared(pdf: pd.DataFrame) -> pd.DataFrame:
    """The forest of a task's rows (key, text); a row whose text isn't of its class is another of the same id."""
    sets: dict[int, np.ndarray] = {}
    for key, text in zip(pdf["key"].tolist(), pdf["text"], strict=True):
        if key not in sets and key_of(found := shingles(text)) == key:
            sets[key] = found
    keys = sorted(sets)
    return pd.DataFrame(forest(keys, [sets[k] for k in keys]) if len(keys) > 1 else [], columns=["a", "b"]).astype("int64")


def fingerprint_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a > b: the tries' links between classes with shingles; classes of one fingerprint are linked to its least key."""
    prints = classes.where(F.size("bands") > 0).select("key", "fp")
    named = stored(prints.groupBy("fp").agg(F.min("key").alias("rep"), F.count("*").alias("n")), "tries")
    held = F.broadcast if (several := named.where("n > 1").select("fp", "rep")).count() <= HELD else lambda df: df
    same = prints.join(held(several), "fp").where("key > rep").select(F.col("key").alias("a"), F.col("rep").alias("b"))
    return links(named.select("fp", "rep"), radius).union(same)


def candidates(classes: DataFrame) -> DataFrame:
    """(key, grp) of every class that the tries link to another or that shares a bucket with one; groups are joined links."""
    dealt = classes.select("key", F.explode("bands").alias("bucket"))
    buckets = stored(dealt.groupBy("bucket").agg(F.min("key").alias("low"), F.count("*").alias("n")).where("n > 1").select("bucket", "low"), "buckets")
    held = F.broadcast if buckets.count() <= HELD else lambda df: df
    edges = dealt.join(held(buckets), "bucket").where("key > low").select(F.col("key").alias("a"), F.col("low").alias("b")).distinct()
    found = star_components(edges.union(fingerprint_links(classes)).distinct()).select(F.col("node").alias("key"), F.col("component").alias("grp"))
    return found.union(found.select(F.col("grp").alias("key"), "grp").distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id and component_id (the least id) of every row with an id."""
    prints = stored(signed(docs, id_col, text_col), "shingled")
    classes = stored(prints.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "classes")
    grouped = candidates(classes)
    sizes = grouped.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(block)).alias("parts"))
    held = F.broadcast if sizes.count() <= HELD else lambda df: df
    texts = docs.select(docs[id_col].cast("long").alias("rep"), docs[text_col].alias("text"))
    # the whole distinct row: copies of an id with one text are one
    members = grouped.join(held(sizes), "grp").join(classes.select("key", "rep"), "key").withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    members = stored(members.join(texts, "rep").select("grp", "parts", "part", "key", "text"), "members")
    edges = stored(members.groupBy("grp", "part").applyInPandas(compared, "a long, b long"), "edges")
    linked = star_components(edges)
    wide = members.where("parts > 1")
    if not wide.isEmpty():
        named = linked.withColumnRenamed("node", "key")
        wide = stored(wide.join(named, "key", "left").withColumn("component", F.coalesce("component", "key")), "wide")
        counts = wide.groupBy("grp", "component").agg(F.countDistinct("key").alias("n"))
        largest = counts.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("top"), (F.sum("n") - F.max("n")).alias("others")).where("others > 0")
        largest = stored(largest.select("grp", F.col("top.component").alias("top"), F.ceil(F.col("others") / F.lit(block)).alias("rounds")), "largest")
        met = wide.join(F.broadcast(largest), "grp")  # a row for each group of over ``block`` classes
        once = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        all_of = met.select("grp", "part", once("rounds").alias("round"), "key", "text")
        rest = met.where("component <> top").select("grp", once("parts").alias("part"), F.pmod(F.xxhash64("key", F.lit(1)), "rounds").alias("round"), "key", "text")
        more = all_of.union(rest).groupBy("grp", "part", "round").applyInPandas(compared, "a long, b long")
        linked = star_components(stored(edges.union(more).distinct(), "edges"))
    named = classes.join(linked, classes["key"] == linked["node"], "left").select("key", "rep", F.coalesce("component", "key").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return prints.select("doc_id", "key").join(named.join(least, "component").select("key", "component_id"), "key").select("doc_id", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """``keep_representatives`` by components of shingles.

    Texts without a word (null, empty) are one class; ids of any size are exact; repeated rows of a kept id
    stay together; a very long text is compared whole; a pair at exactly the threshold is linked; an
    empty table gives an empty result; other columns stay as they are, whatever their names.
    """
    return keep_representatives(docs, jaccard_components(docs, id_col, text_col, **options), id_col)
