"""SimHash near-duplicates by a self-join of binary tries.

1. Each text gets a 64-bit fingerprint; equal fingerprints collapse to one class (partial aggregation).
2. The classes are dealt several times, each time led by other blocks of bits, to the subtrees at the top
   of a binary trie over those bits: of radius + 1 blocks, two classes within the radius agree in one.
   Every subtree is one task; subtrees above ``block`` classes are cut into chunks, two for each task.
3. In a task the two tries descend together.  A node is a range of a sorted array; the differing bits
   add up on the way and a node pair is dropped once they exceed the radius.  Small node pairs compare
   their leaves at once.  A task gives a spanning forest of its links, not the links.
4. Stars are contracted over the forests until nothing changes; each round is checkpointed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, shared_dir, stored

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Edges in a partition of a checkpoint: components shrink fast, and their files should not outnumber them.
EDGES = 50_000
#: Up to so many edges, a table with a row for each node (16 bytes) is broadcast.
HELD = 200_000
#: Up to so many ids of documents that go (8 bytes each) are broadcast.
MAX_GONE = 2_000_000
SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint of the shingles of ``width`` words; 0 if there is no word."""
    data = text.encode("utf-8", "replace") if isinstance(text, str) else b""
    words = data.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << SHIFTS[2 * bits > n]).sum(dtype=np.uint64)) if (2 * bits > n).any() else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.fromiter((fingerprint(t, width) for t in pdf["text"]), np.uint64, len(pdf))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})

    return map_slices(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).where("doc_id is not null"), run, "doc_id long, fp long")


# ---------------------------------------------------------------- one pair of subtrees


def components(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of n nodes: hooking and pointer jumping on whole arrays."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[u], label[v]
        if (differ := a != b).any():
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != (up := label[label])).any():
                label = up
        else:
            return label


def trie_links(left: np.ndarray, right: np.ndarray | None, radius: int, leaf: int = 256, batch: int = 1 << 21) -> np.ndarray:
    """Component labels of the sorted unique fingerprints left (and right), linked at ``radius`` bits.

    With right None, the trie of left joins itself; a node pair (x, y) is then only visited with x <= y.
    """
    own = right is None
    a, b = left, left if own else right
    shift = 0 if own else len(a)
    label = np.arange(len(a) + (0 if own else len(b)))
    todo = [(np.array([[0, len(a), 0, len(b), 0]], np.int64), 63)]
    while todo:
        nodes, bit = todo.pop()
        while len(nodes):
            small = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= leaf) | (bit < 0)
            label = leaves(a, b, nodes[small], radius, shift, label, batch)
            nodes = nodes[~small]
            if not len(nodes):
                break
            if len(nodes) > batch >> 3:  # bound the frontier: the rest waits
                todo.append((nodes[batch >> 3 :], bit))
                nodes = nodes[: batch >> 3]
            one = np.uint64(1) << np.uint64(bit)
            high = ~((one << np.uint64(1)) - np.uint64(1)) if bit < 63 else np.uint64(0)
            am = np.searchsorted(a, (a[nodes[:, 0]] & high) | one)
            bm = np.searchsorted(b, (b[nodes[:, 2]] & high) | one)
            al, ah, bl, bh, used = nodes.T
            parts = []
            for x, y, p, q, d in ((al, am, bl, bm, 0), (am, ah, bm, bh, 0), (al, am, bm, bh, 1), (am, ah, bl, bm, 1)):
                keep = (x < y) & (p < q) & (used + d <= radius)
                if own:  # the mirror image of a pair of unlike nodes is visited once
                    keep &= x <= p
                parts.append(np.stack([x, y, p, q, used + d], axis=1)[keep])
            nodes, bit = np.concatenate(parts), bit - 1
    return label


def leaves(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, radius: int, shift: int, label: np.ndarray, batch: int) -> np.ndarray:
    if not len(nodes):
        return label
    wide = nodes[:, 3] - nodes[:, 2]
    sizes = (nodes[:, 1] - nodes[:, 0]) * wide
    first, cuts = 0, np.cumsum(sizes)
    while first < len(nodes):
        last = max(first + 1, int(np.searchsorted(cuts, (cuts[first - 1] if first else 0) + batch, "right")))
        part = slice(first, last)
        n = sizes[part]
        node = np.repeat(np.arange(first, last), n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = nodes[node, 0] + at // wide[node]
        j = nodes[node, 2] + at % wide[node]
        near = np.bitwise_count(a[i] ^ b[j]) <= radius
        if near.any():
            label = components(len(label), i[near], j[near] + shift, label)
        first = last
    return label


# ---------------------------------------------------------------- the distributed join


def blocks_of(m: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of m blocks of a fingerprint."""
    cuts = [round(64 * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def deals(n: int, radius: int, block: int) -> tuple[list[tuple[tuple[int, int], ...]], int]:
    """Which blocks of bits lead each deal, and how many of their bits name a subtree.

    With m blocks, two fingerprints within the radius agree in m - radius of them at least, so that they
    meet in the deal led by those.  m is the least with which the leading bits can part n classes in
    subtrees of half a ``block``: m is radius + 1 up to hundreds of millions of classes, and each class is
    copied once for each deal, whatever n.
    """
    want = max(0, int(np.ceil(np.log2(max(1.0, n / (block / 2))))))
    m = radius + 1
    while m < 2 * radius + 2 and min(sum(w for _, w in c) for c in combinations(blocks_of(m), m - radius)) < want:
        m += 1
    leads = list(combinations(blocks_of(m), m - radius))
    return leads, min(want, *(sum(w for _, w in c) for c in leads))


def leading(fp: Column, lead: tuple[tuple[int, int], ...], bits: int) -> Column:
    """The first ``bits`` bits of the blocks that lead a deal."""
    out, total = F.lit(0).cast("long"), 0
    for first, width in lead:
        part = F.shiftrightunsigned(fp, 64 - first - width) if first + width < 64 else fp
        if width < 64:
            part = part.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out, total = F.shiftleft(out, width).bitwiseOR(part) if total else part, total + width
    return F.shiftrightunsigned(out, total - bits) if bits < total else out


def dealt(classes: DataFrame, radius: int, block: int) -> DataFrame:
    """(deal, prefix, low, high, chunk, fp, rep): every class in each of its tasks.

    A task is a subtree, or two chunks of one that has over ``block`` classes.
    """
    leads, bits = deals(classes.count(), radius, block)
    prefix = [F.struct(F.lit(i).alias("deal"), (leading(F.col("fp"), c, bits) if bits else F.lit(0).cast("long")).alias("prefix")) for i, c in enumerate(leads)]
    if not bits:  # one subtree: any deal has all pairs
        prefix = prefix[:1]
    rows = classes.select(F.explode(F.array(*prefix)).alias("d"), "fp", "rep").select("d.*", "fp", "rep")
    large = stored(rows.groupBy("deal", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > block).select("deal", "prefix", F.ceil(F.col("n") / block).cast("int").alias("parts")), "subtrees")
    few = large.count()
    if not few:
        return rows.select("deal", "prefix", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("chunk"), "fp", "rep")
    parted = rows.join(F.broadcast(large) if few <= HELD else large, ["deal", "prefix"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    chunk = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = parted.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select("deal", "prefix", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "fp", "rep")


def forest_of(pdf: pd.DataFrame, radius: int) -> pd.DataFrame:
    """A spanning forest of the links of a task, between representatives."""
    key, rep = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["rep"].to_numpy(np.int64)
    low, high = int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0])
    side = pdf["chunk"].to_numpy() != low if low != high else np.zeros(len(pdf), bool)
    order = np.lexsort((key, side))
    key, rep, n = key[order], rep[order], int((~side).sum())
    if low == high:
        label = trie_links(key, None, radius)
    elif 0 < n < len(key):
        label = trie_links(key[:n], key[n:], radius)
    else:
        return pd.DataFrame({"a": rep[:0], "b": rep[:0]})
    least = rep.copy()
    np.minimum.at(least, label, rep)
    root = least[label]
    return pd.DataFrame({"a": rep[root != rep], "b": root[root != rep]})


def links(classes: DataFrame, radius: int = 3, block: int = 8192) -> DataFrame:
    """(a, b): edges of a spanning forest of each task's links between representatives, a > b."""
    grouped = dealt(classes, radius, block).groupBy("deal", "prefix", "low", "high")
    return grouped.applyInPandas(lambda pdf: forest_of(pdf, radius), "a long, b long").distinct()


def star_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a > b) reaches.

    Alternating stars: the larger neighbours of a node move to its smallest neighbour, then the smaller
    ones do.  Every round aggregates before it shuffles and ends in a checkpoint; the loop ends when a
    round changes no edge.
    """
    shared_dir(edges.sparkSession)
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = edges.checkpoint()
    before = mark(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        held = F.broadcast if before[0] <= HELD else lambda df: df  # beyond that, joins by key that Spark splits where one is frequent
        large = both.where("b > a").join(held(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(held(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = small.coalesce(max(1, -(-before[0] // EDGES))).checkpoint()
        after = mark(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after
    raise RuntimeError("the components did not settle")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, block: int = 8192) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Null and empty texts have fingerprint zero and link like any other; a row whose id is null takes no
    part and is left out; ids of any size are exact.  Repeated rows give repeated results; of rows with one
    id and different texts, each has its own component.  A very long text is read whole.  A bit set in
    exactly half of the hashes is 0.  An empty table gives an empty result; other columns, whatever their
    names, are not read.
    """
    spark = docs.sparkSession
    prints = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comps = star_components(links(classes, radius, block))
    named = classes.join(comps, classes["rep"] == comps["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    hexed: Column = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """The rows of each component's smallest id, with all their columns, and rows without an id.

    The ids that go are held by each task if there are at most MAX_GONE, so that no text moves; otherwise
    the texts move once, to their ids.  Repeated rows of a kept id are one document and stay together.
    """
    own = found.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("own"))
    gone = stored(own.where("own = 0").select(F.col("doc_id").alias("__gone")), "gone")
    gone = F.broadcast(gone) if gone.count() <= MAX_GONE else gone
    return docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """``keep_representatives`` by components of fingerprints."""
    return keep_representatives(docs, simhash_components(docs, id_col, text_col, **options), id_col)
