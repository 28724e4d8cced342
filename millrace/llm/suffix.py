"""Exact substring dedup by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.

1. Candidates.  Every window of LENGTH bytes names an anchor: the ANCHOR-byte string in it whose hash is
   least.  Equal windows name equal anchors.  Consecutive windows with one anchor form a segment.  The
   documents are dealt to units by a hash of their id; a unit tells each bucket of anchors which anchors
   it has, once, however often they occur.  An anchor that no two documents share starts no match.
2. Index.  A unit sorts its segments of shared anchors as suffixes; of equal neighbours the smallest document
   stands for all.  The distinct ones go to the bucket of their anchor.  There they come in order of their
   smallest document, in batches.  A batch gets the suffix array of its segments, which is merged with
   that of each level: the neighbours of a suffix in the merged order give the longest string, of LENGTH
   bytes or more, that starts in an earlier document.  What no level has becomes a level, and levels of
   like size merge, so that there are O(log n).  A bucket is indexed in SUBS parts, by its anchors.
3. Cuts.  Each unit gets the matched windows of its segments back and cuts the spans out of its texts.

All three steps read one exchange of the texts.  Between them go only anchors and the segments of shared
anchors; a passage with many copies goes once for each unit that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mix64, trim, utf8

LENGTH = 50
ANCHOR = 24
SPREAD = LENGTH - ANCHOR + 1
LOW = np.uint64(63)
PIECE = 1 << 18
UNIT_BYTES = 6 << 20
#: Partitions of the texts at most; beyond that a partition has several units, which are still read one at a time.
MAX_PARTS = 20_000
#: Units for each bucket of anchors.
UNITS = 1
#: Parts of a bucket, by other bits of the anchor, that its task indexes one after another: no more than one is in memory.
SUBS = 4
BATCH = 1 << 16
#: The longest segment, and the bytes of a key: a segment or suffix, filled up with zeros, and its length.
WIDE = LENGTH + SPREAD - 1
KEY = f"S{WIDE + 1}"

# ---------------------------------------------------------------- segments of a unit


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position on, by doubling."""
    b = data.astype(np.uint64) + np.uint64(1)
    p = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        two = b[:-1] * p + b[1:]
        p = p * p
        four = two[:-2] * p + two[2:]
        p = p * p
        eight = four[:-4] * p + four[4:]
        q = p * p
        sixteen = eight[:-8] * q + eight[8:]
        return mix64(sixteen[:-8] * q + eight[16:])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, anchor's hash) of each segment of texts that lie in ``data``."""
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    key = gram_hashes(data)
    key = (key & ~LOW) | (np.arange(len(key), dtype=np.uint64) & LOW)
    low = sliding_min(key, SPREAD)
    fits = np.zeros(len(low) + 1, np.int8)
    ok = ends - starts >= LENGTH
    np.add.at(fits, starts[ok], 1)
    np.add.at(fits, ends[ok] - LENGTH + 1, -1)
    valid = np.cumsum(fits[:-1], dtype=np.int8) > 0
    # Windows of different texts are never next to each other, and equal minima next to each other are one anchor.
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    done = valid.copy()
    done[:-1] &= (low[1:] != low[:-1]) | ~valid[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(done)
    return np.searchsorted(starts, first, "right") - 1, first, last, low[first] & ~LOW


def pieces_of(blobs: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Bytes of at most about PIECE, with (text, offset in it) of each part; parts of one text overlap by LENGTH - 1."""
    parts: list[bytes] = []
    names: list[tuple[int, int]] = []
    size = 0
    for i, blob in enumerate(blobs):
        for offset in range(0, max(1, len(blob) - LENGTH + 1), PIECE):
            part = blob if len(blob) <= PIECE + LENGTH else blob[offset : offset + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield b"".join(parts), [*names, (0, 0)], [0, *np.cumsum([len(p) for p in parts]).tolist()]
                parts, names, size = [], [], 0
            parts.append(part)
            names.append((i, offset))
            size += len(part)
            if len(part) == len(blob):
                break
    if parts:
        yield b"".join(parts), [*names, (0, 0)], [0, *np.cumsum([len(p) for p in parts]).tolist()]


class Unit:
    """The segments of a unit's texts, which come in order of their ids."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        self.frame = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
        self.ids = self.frame["doc_id"].to_numpy(np.int64)
        self.blobs = utf8(self.frame["text"])

    def parts(self) -> Iterator[tuple]:
        """(bytes, text of each segment, offset, first, last, hash): positions in the bytes; offset to those in the text."""
        for data, names, cuts in pieces_of(self.blobs):
            bounds = np.array(cuts, np.int64)
            which, first, last, anchor = segments(np.frombuffer(data, np.uint8), bounds[:-1], bounds[1:])
            text = np.array([n[0] for n in names], np.int64)[which]
            shift = np.array([n[1] for n in names], np.int64)[which] - bounds[which]
            yield data, text, shift, first, last, anchor

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and whether two documents of the unit have them."""
        found = [(anchor, self.ids[text]) for _, text, _, _, _, anchor in self.parts()]
        if not found:
            return np.empty(0, np.uint64), np.empty(0, bool)
        anchor, doc = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(anchor, kind="stable")
        anchor, doc = anchor[order], doc[order]
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.empty(0, np.int64)
        if not len(start):
            return anchor, np.empty(0, bool)
        return anchor[start], np.maximum.reduceat(doc, start) != np.minimum.reduceat(doc, start)

    def shared(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, text, first window in the text, windows, key) of the segments with one of the sorted anchors."""
        found = []
        if len(anchors):
            for data, text, shift, first, last, anchor in self.parts():
                at = np.searchsorted(anchors, anchor)
                hit = np.flatnonzero(anchors[np.minimum(at, len(anchors) - 1)] == anchor)
                sizes = last[hit] - first[hit] + LENGTH
                found.append((anchor[hit], text[hit], (first + shift)[hit], sizes - LENGTH + 1, keys_of(np.frombuffer(data, np.uint8), first[hit], sizes)))
        if not found:
            none = np.empty(0, np.int64)
            return none.astype(np.uint64), none, none, none, np.empty(0, KEY)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---------------------------------------------------------------- suffixes


def keys_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sortable keys of strings in ``data``: their bytes, zeros up to WIDE, and the length, which parts strings that end in zeros."""
    padded = np.concatenate((data, np.zeros(WIDE, np.uint8)))
    out = np.empty((len(starts), WIDE + 1), np.uint8)
    out[:, :WIDE] = np.lib.stride_tricks.sliding_window_view(padded, WIDE)[starts]
    out[:, :WIDE][np.arange(WIDE) >= sizes[:, None]] = 0
    out[:, WIDE] = sizes
    return out.view(KEY).ravel()


def bytes_of(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint8).reshape(len(keys), WIDE + 1)


def sizes_of(keys: np.ndarray) -> np.ndarray:
    return bytes_of(keys)[:, WIDE].astype(np.int64)


def suffixes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, segment, window) of all suffixes of LENGTH bytes or more."""
    sizes = sizes_of(keys)
    counts = sizes - LENGTH + 1
    segment = np.repeat(np.arange(len(keys)), counts)
    window = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.ascontiguousarray(bytes_of(keys)[:, :WIDE]).ravel()
    return keys_of(flat, segment * WIDE + window, sizes[segment] - window), segment, window


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of the longest common prefix of each two keys."""
    x, y = bytes_of(a), bytes_of(b)
    differ = x[:, :WIDE] != y[:, :WIDE]
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), WIDE), np.minimum(x[:, WIDE], y[:, WIDE]))


def least_of(ranked: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each key of a suffix array, the smallest document of those that share its first LENGTH bytes."""
    head = bytes_of(ranked)[:, :LENGTH]
    start = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]).any(axis=1))))
    return np.repeat(np.minimum.reduceat(docs, start), np.diff(np.append(start, len(ranked))))


def distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys in suffix order, smallest document of each, number of each given key among them): equal neighbours are one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)]
    start = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[start], np.minimum.reduceat(docs[order], start) if len(start) else docs[:0], number


class Family:
    """Levels: suffix arrays with the smallest document of each LENGTH-byte head; sizes at least double from level to level."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge a suffix array with each level.

        For each suffix the longest match with a neighbour in the merged orders, and the smallest document
        of any level with a match of LENGTH bytes or more, and of those that match the whole suffix.
        """
        longest = np.zeros(len(ranked), np.int64)
        least = np.full(len(ranked), np.iinfo(np.int64).max)
        whole = least.copy()
        for known, first in self.levels:
            place = np.searchsorted(known, ranked)  # of a sorted array: the positions of the merge
            for at in (place, place - 1):
                ok = np.flatnonzero((at >= 0) & (at < len(known)))
                length = common(known[at[ok]], ranked[ok])
                longest[ok] = np.maximum(longest[ok], length)
                ok, length = ok[length >= LENGTH], length[length >= LENGTH]
                least[ok] = np.minimum(least[ok], first[at[ok]])
                ok = ok[length == sizes_of(ranked[ok])]
                whole[ok] = np.minimum(whole[ok], first[at[ok]])
        return longest, least, whole

    def add(self, ranked: np.ndarray, docs: np.ndarray) -> None:
        """A suffix array that becomes a level, and merges with those of like size."""
        while self.levels and len(self.levels[-1][0]) <= 2 * len(ranked):
            known, first = self.levels.pop()
            both = np.concatenate((known, ranked))
            order = np.argsort(both, kind="stable")  # two sorted runs: a merge
            ranked, docs = both[order], np.concatenate((first, docs))[order]
        if len(ranked):
            self.levels.append((ranked, least_of(ranked, docs)))

    def take(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Masks of a batch of segments, each with its smallest document; no document is smaller than one of an earlier batch.

        Bit i is set if the i-th window of the segment starts in a smaller document too.  A segment that an
        earlier document has whole is one long match: its other suffixes need neither scan nor place.
        """
        ranked, least, number = distinct(keys, docs)
        whole = self.scan(ranked)[2]
        own = np.flatnonzero(whole >= least)  # a level that has all of the others already has their suffixes too
        parts, segment, window = suffixes(ranked[own])
        order = np.argsort(parts, kind="stable")
        parts, segment, window = parts[order], segment[order], window[order]
        of = least[own][segment]
        longest, before, _ = self.scan(parts)
        first = np.minimum(before, least_of(parts, of)) if len(parts) else before
        masks = np.zeros(len(ranked), np.int64)
        np.bitwise_or.at(masks, own[segment], (first < of).astype(np.int64) << window)
        masks[whole < least] = (1 << (sizes_of(ranked[whole < least]) - LENGTH + 1)) - 1
        fresh = longest < sizes_of(parts) if len(parts) else np.zeros(0, bool)
        self.add(parts[fresh], of[fresh])
        full = (1 << (sizes_of(keys) - LENGTH + 1)) - 1
        return np.where(docs > least[number], full, masks[number])


def matched(docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The mask of each segment: which of its windows start in a document smaller than its own, by batches of a family."""
    order = np.argsort(docs, kind="stable")
    sizes = np.cumsum(sizes_of(keys[order]) - LENGTH + 1)
    family = Family()
    masks = np.zeros(len(keys), np.int64)
    at = 0
    while at < len(order):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH, "right")))
        part = order[at:end]
        masks[part] = family.take(keys[part], docs[part])
        at = end
    return masks


# ---------------------------------------------------------------- the plan

ANSWER = "unit int, bucket int, kind byte, numbers binary, masks binary"


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def sub_of(anchor: np.ndarray) -> np.ndarray:
    return ((anchor >> np.uint64(16)) % np.uint64(SUBS)).astype(np.int32)


def by_bucket(anchors: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices in order) of an array of anchors."""
    own = bucket_of(anchors, buckets)
    order = np.argsort(own, kind="stable")
    cuts = np.flatnonzero(np.diff(own[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(own[part[0]]), part


def cut_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = UNIT_BYTES, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text of every row.

    Columns named in ``carry`` follow as carry0, carry1 and so on.

    Null and empty texts have no bytes.  Rows with the same id never cut each other.  A row without an id
    is compared with none and kept whole; ids of any size are exact.  Repeated rows are cut alike.  A very
    long text is read whole, with its unit.  An empty table gives an empty result; columns that are not in
    ``carry`` are not read, whatever their names.  kept_text is the kept bytes as UTF-8 without the
    characters that a cut has split.
    """
    whole_numbers = {c for c, kind in docs.dtypes if kind in ("bigint", "int")}  # as text on the way: nulls would make them doubles
    extra = [(docs[c].cast("string") if c in whole_numbers else docs[c]).alias(f"carry{i}") for i, c in enumerate(carry)]
    others = [f"carry{i}" for i in range(len(carry))]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *extra)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = int(max(1, -(-total // unit_bytes)))
    buckets = -(-units // UNITS)
    texts = rows.where("doc_id is not null").select(F.pmod(F.xxhash64("doc_id"), F.lit(units)).cast("int").alias("unit"), "doc_id", "text", *others).repartition(min(units, MAX_PARTS), "unit")

    def tell(pdf: pd.DataFrame) -> pd.DataFrame:
        anchors, many = Unit(pdf).anchors()
        trim()
        out = [(b, anchors[at].tobytes(), many[at].tobytes()) for b, at in by_bucket(anchors, buckets)]
        frame = pd.DataFrame(out, columns=["bucket", "numbers", "masks"])
        frame.insert(0, "unit", np.int32(pdf["unit"].iloc[0]))
        return frame

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, np.uint64) for x in pdf["numbers"]]
        flat = np.concatenate(own)
        many = np.concatenate([np.frombuffer(x, bool) for x in pdf["masks"]])
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        same = ranked[1:] == ranked[:-1]
        hit = many.copy()
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        parts = np.split(hit, np.cumsum([len(o) for o in own])[:-1])
        out = [(u, b, o[h].tobytes()) for u, b, o, h in zip(pdf["unit"], pdf["bucket"], own, parts, strict=True) if h.any()]
        frame = pd.DataFrame(out, columns=["unit", "bucket", "numbers"])
        return frame.assign(kind=np.int8(0), masks=None)[["unit", "bucket", "kind", "numbers", "masks"]]

    def numbered(unit: Unit, answers: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """The segments of shared anchors (anchor, text, first window, windows), the number of each among the distinct ones, those in suffix order, and their smallest documents."""
        blobs = [np.frombuffer(x, np.uint64) for x in answers.loc[answers["kind"] == 0, "numbers"]]
        anchor, text, first, count, keys = unit.shared(np.sort(np.concatenate(blobs)) if blobs else np.empty(0, np.uint64))
        ranked, least, number = distinct(keys, unit.ids[text])
        return anchor, text, first, count, number, ranked, least

    def send(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "unit", "parts", "lengths", "docs", "numbers", "data", "size"]
        if not len(texts) or not len(answers):
            return pd.DataFrame(columns=columns)
        own, _, _, _, number, ranked, least = numbered(Unit(texts), answers)
        anchor = np.zeros(len(ranked), np.uint64)
        anchor[number] = own
        packer = zstandard.ZstdCompressor(level=1)
        out = []
        for b, at in by_bucket(anchor, buckets):
            sub = sub_of(anchor[at])
            at = at[np.lexsort((at, sub))]
            raw, sizes = bytes_of(ranked[at]), sizes_of(ranked[at])
            data = raw[:, :WIDE][np.arange(WIDE) < sizes[:, None]].tobytes()
            out.append((b, int(texts["unit"].iloc[0]), np.bincount(sub, minlength=SUBS).astype(np.int32).tobytes(), sizes.astype(np.uint8).tobytes(), least[at].tobytes(), at.astype(np.int32).tobytes(), packer.compress(data), len(data)))
        return pd.DataFrame(out, columns=columns)

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        rows = []
        for r in pdf.itertuples():
            sizes = np.frombuffer(r.lengths, np.uint8).astype(np.int64)
            starts, cuts = np.cumsum(sizes) - sizes, np.concatenate(([0], np.cumsum(np.frombuffer(r.parts, np.int32))))
            rows.append((np.frombuffer(opener.decompress(r.data, max_output_size=max(1, r.size)), np.uint8), starts, sizes, np.frombuffer(r.docs, np.int64), cuts, np.zeros(len(sizes), np.int64)))
        for k in range(SUBS):
            own = [slice(row[4][k], row[4][k + 1]) for row in rows]
            found = matched(np.concatenate([row[3][at] for row, at in zip(rows, own, strict=True)]), np.concatenate([keys_of(row[0], row[1][at], row[2][at]) for row, at in zip(rows, own, strict=True)]))
            done = 0
            for row, at in zip(rows, own, strict=True):
                row[5][at] = found[done : done + at.stop - at.start]
                done += at.stop - at.start
        out = []
        for unit, numbers, row in zip(pdf["unit"], pdf["numbers"], rows, strict=True):
            names, masks = np.frombuffer(numbers, np.int32), row[5]
            if (some := masks != 0).any():
                out.append((unit, int(pdf["bucket"].iloc[0]), 1, names[some].tobytes(), masks[some].astype(np.uint32).tobytes()))
        trim()
        return pd.DataFrame(out, columns=["unit", "bucket", "kind", "numbers", "masks"]).astype({"unit": "int32", "bucket": "int32", "kind": "int8"})

    kinds = dict(rows.dtypes)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if keep_text else "")

    def report(doc_id: object, blob: bytes, starts: np.ndarray) -> tuple:
        removed = spans = 0
        kept = blob
        if len(starts):
            step = np.zeros(len(blob) + 1, np.int32)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + LENGTH, -1)
            gone = np.cumsum(step[:-1]) > 0
            removed = int(gone.sum())
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(blob, np.uint8)[~gone].tobytes()
        row = doc_id, len(blob), removed, spans, hashlib.sha256(kept).hexdigest()
        return (*row, kept.decode("utf-8", "ignore")) if keep_text else row

    names = [c.split(" ")[0] for c in schema.split(", ")]
    full = schema + "".join(f", {c} {kinds[c]}" for c in others)

    def cut(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        unit = Unit(texts) if len(texts) else None
        if unit is None:
            return pd.DataFrame(columns=[*names, *others])
        _, text, first, count, number, ranked, least = numbered(unit, answers)
        masks = np.zeros(len(ranked), np.int64)
        for r in answers[answers["kind"] == 1].itertuples():
            masks[np.frombuffer(r.numbers, np.int32)] = np.frombuffer(r.masks, np.uint32)
        # Of equal segments of this unit, those of later documents are matched over their whole length.
        mask = np.where(unit.ids[text] > least[number], (1 << count) - 1, masks[number])
        row, bit = np.nonzero(mask[:, None] >> np.arange(SPREAD) & 1)
        starts = first[row] + bit
        ends = np.searchsorted(text[row], np.arange(len(unit.blobs)), "right")
        out = pd.DataFrame([report(d, b, starts[i:j]) for d, b, i, j in zip(unit.ids.tolist(), unit.blobs, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)], columns=names)
        return pd.concat([out, unit.frame[others]], axis=1)

    told = texts.groupBy("unit").applyInPandas(tell, "unit int, bucket int, numbers binary, masks binary")
    shared = told.groupBy("bucket").applyInPandas(compare, ANSWER)
    sent = texts.groupBy("unit").cogroup(shared.groupBy("unit")).applyInPandas(send, "bucket int, unit int, parts binary, lengths binary, docs binary, numbers binary, data binary, size long")
    found = sent.groupBy("bucket").applyInPandas(index, ANSWER)
    done = texts.groupBy("unit").cogroup(shared.union(found).groupBy("unit")).applyInPandas(cut, full)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([report(None, b, np.empty(0, np.int64)) for b in utf8(pdf["text"])], columns=names)
            yield pd.concat([out.astype({"doc_id": "Int64"}), pdf[others].reset_index(drop=True)], axis=1)

    every = done.union(rows.where("doc_id is null").mapInPandas(whole, full))
    return every.select(*names, *(F.col(o).cast(dict(docs.dtypes)[c]).alias(o) for o, c in zip(others, carry, strict=True)))
