"""Order-preserving packing of tokenised documents by dynamic programming.

The documents of a task form one stream of ids.  A window holds at most ``size`` ids; cuts may fall at
document ends (free), at sentence ends (``SENTENCE`` points) and, in sentences too long for that, at
fixed steps (``HARD`` points).  A point of cost is one id of padding.  With positions ``p`` and costs
``c`` the best total up to a cut j is

    best[j] = c[j] + min over cuts i with p[j] - p[i] <= size of (best[i] + size - (p[j] - p[i]))

whose inner minimum of ``best[i] + p[i]`` a monotone queue gives as the window moves, or without any
padding from a cut i at a power of two (of at least ``LEAST``) before j, as such windows are not padded.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.common import chunks, exact_ids, frame_of, map_slices, trim

END_ID = 1
SIZE = 2048
SENTENCE, HARD = 2, 24
STEP = 64
CHUNK = 1 << 19
#: Characters that are encoded at once: what Arrow makes of them takes several times their bytes.
PIECE = 2 << 20
CACHE = 200_000
#: Words that go to the library at once.
PART = 512
#: Shorter windows than this are padded like others, so that texts aren't cut into crumbs.
LEAST = 128

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Runs of these characters normalise one by one: lower case is all that the tokenizer changes.
SIMPLE = re.compile(r"[\x00-\x7fÀ-ÿœŒ]+")
ALL_SIMPLE = r"^[\x00-\x7fÀ-ÿœŒ]*$"
LETTERS, PRINTABLE = r"^[A-Za-z]+$", r"^[ -~]*$"
#: The tokenizer's pattern for them.
TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[^a-z0-9ß-öø-ÿœ]+")


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of runs that start and have as many in ``ids`` as given, one run after another."""
    ends = np.cumsum(sizes, dtype=np.int32)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at]


class Known:
    """Ids of distinct strings, in arrays: a third of what dictionaries of Python objects take."""

    def __init__(self) -> None:
        self.keep(pa.array([], pa.large_string()), np.empty(0, np.int32), np.empty(0, np.uint32))

    def __len__(self) -> int:
        return len(self.names)

    def keep(self, names: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Know these strings only."""
        self.names, self.sizes, self.ids = names, sizes, ids

    def find(self, names: pa.Array) -> np.ndarray:
        """The number of each string, -1 for new ones."""
        if not len(self):
            return np.full(len(names), -1, np.int32)
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().copy()

    def add(self, names: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.keep(pa.concat_arrays([self.names, names]), np.concatenate((self.sizes, sizes)), np.concatenate((self.ids, ids)))

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of the strings with these numbers."""
        sizes = self.sizes[at]
        return sizes, gathered(self.ids, (np.cumsum(self.sizes, dtype=np.int32) - self.sizes)[at], sizes)


class WordTokenizer:
    """Ids of texts by a ``tokenizers`` file whose pre-tokenizer drops white space.

    No token spans white space, so each distinct run of other characters is encoded once and kept.  A new
    run is cut into the tokenizer's words, and only words that are new too go to the library, many at a
    time: the last piece of each ends in the end-of-word mark.  Runs with characters that normalise in
    context go to the library whole, parted by a special token.  Of runs and of words, ``CACHE`` at most are
    kept beside those at hand.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # for words that are lower-case printable ASCII: only the merges
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.mark = self.tokenizer.token_to_id("<|endoftext|>")
        self.runs, self.words = Known(), Known()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 2, bool)
        self.last = np.zeros(max(vocab.values()) + 2, bool)
        for piece, i in vocab.items():
            body = piece.removesuffix("</w>")
            self.last[i] = body != piece
            self.ends[i] = body != piece and body.rstrip("\"')»”’")[-1:] in {".", "!", "?"}

    def ids(self, text: str, tokenizer: object = None) -> np.ndarray:
        """The library's ids, without the offsets that nothing here reads."""
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn_words(self, names: pa.Array) -> np.ndarray:
        """The number of each of these distinct words among the known ones, which get those that are new."""
        at = self.words.find(names)
        new = np.flatnonzero(at < 0)
        if not len(new):
            return at
        if len(self.words) > CACHE:  # those at hand stay
            old = np.flatnonzero(at >= 0)
            self.words.keep(names.take(pa.array(old)), *self.words.of(at[old]))
            at[old] = np.arange(len(old), dtype=np.int32)
        words = names.take(pa.array(new))
        plain = pc.match_substring_regex(words, PRINTABLE).to_numpy(zero_copy_only=False)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        words = words.take(pa.array(order))
        at[new[order]] = len(self.words) + np.arange(len(new), dtype=np.int32)
        edge = int(plain.sum())
        sizes, ids = [], []
        for tokenizer, some in ((self.bare, words[:edge]), (self.tokenizer, words[edge:])):
            for a in range(0, len(some), PART):
                part = some[a : a + PART].to_pylist()
                found = self.ids(" ".join(part), tokenizer)
                ends = np.flatnonzero(self.last[found]) + 1
                if len(ends) != len(part):
                    raise ValueError("the tokenizer gave other words than its pattern")
                sizes.append(np.diff(ends, prepend=0).astype(np.int32))
                ids.append(found[: ends[-1]])
        self.words.add(words, np.concatenate(sizes), np.concatenate(ids))
        return at

    def learn(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, sizes, ids) of new runs; sizes and ids are those of the runs in that order."""
        letters = pc.match_substring_regex(names, LETTERS)
        single = letters.to_numpy(zero_copy_only=False)  # one word
        others = np.flatnonzero(~single)
        runs = names.take(pa.array(others)).to_pylist()
        cut: list[int] = []
        counts: list[int] = []
        words: list[str] = []
        whole: list[int] = []
        alone: list[int] = []
        find = TOKEN.findall
        for i, r in enumerate(runs):
            if "<|" in r:
                alone.append(i)
            elif r.isascii() or SIMPLE.fullmatch(r):
                found = find(r.lower())
                cut.append(i)
                counts.append(len(found))
                words += found
            else:
                whole.append(i)
        flat = pa.concat_arrays([pc.ascii_lower(names.filter(letters)), pa.array(words, pa.large_string())]).dictionary_encode()
        del words
        at = self.learn_words(flat.dictionary)[flat.indices.to_numpy()]
        pieces, found = self.words.of(at)
        alike = len(names) - len(others)
        ends = np.concatenate(([0], np.cumsum(pieces, dtype=np.int32)))
        sizes = [pieces[:alike], np.diff(ends[alike + np.concatenate(([0], np.cumsum(counts, dtype=np.int32)))])]
        ids = [found]
        for i in alone:
            ids.append(self.ids(runs[i]))
            sizes.append(np.array([len(ids[-1])], np.int32))
        for a in range(0, len(whole), 4096):
            part = whole[a : a + 4096]
            found = self.ids(" <|endoftext|> ".join([runs[i] for i in part]))
            ends = np.append(np.flatnonzero(found == self.mark), len(found))
            if len(ends) != len(part):
                raise ValueError("the tokenizer gave other words than its pattern")
            ids.append(found[found != self.mark])
            sizes.append((np.diff(ends, prepend=-1) - 1).astype(np.int32))
        order = np.concatenate((np.flatnonzero(single), others[np.array(cut + alone + whole, np.int64)]))
        return order, np.concatenate(sizes).astype(np.int32), np.concatenate(ids)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Each text's ids as unsigned 32-bit integers; a null text has none.

        Arrow splits the texts, numbers the distinct runs and finds the known ones; ids are gathered for all runs at once.
        """
        for a, b in chunks([t if isinstance(t, str) else "" for t in texts], PIECE):
            try:
                array = pa.array(texts[a:b], pa.large_string(), from_pandas=True).fill_null("")
            except UnicodeEncodeError:  # a lone surrogate
                array = pa.array([t.encode("utf-8", "replace").decode() if isinstance(t, str) else "" for t in texts[a:b]], pa.large_string())
            # Texts whose characters normalise one by one are lowered here, so that a word's forms are one run.
            simple = pc.and_not(pc.match_substring_regex(array, ALL_SIMPLE), pc.match_substring(array, "<|"))
            runs = pc.ascii_split_whitespace(pc.if_else(simple, pc.utf8_lower(array), array))
            flat = runs.flatten().dictionary_encode()
            names, index, cuts = flat.dictionary, flat.indices.to_numpy(), runs.offsets.to_numpy()
            del array, simple, runs
            at = self.runs.find(names)
            new = np.flatnonzero(at < 0)
            if len(new):
                order, sizes, ids = self.learn(names.take(pa.array(new)))
                new = new[order]
                at[new] = len(self.runs) + np.arange(len(new), dtype=np.int32)
                self.runs.add(names.take(pa.array(new)), sizes, ids)
            counts, out = self.runs.of(at[index])
            ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int32)))
            if len(self.runs) > CACHE:  # those at hand stay
                self.runs.keep(names, *self.runs.of(at))
            cuts = ends[cuts].tolist()
            del flat, names, index, at, new, counts, ends
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                yield out[i:j]


def best_cuts(pos: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """Indices of the cuts of the cheapest packing of [pos[0], pos[-1]]; gaps are at most ``size``."""
    n = len(pos)
    powers = [1 << k for k in range(size.bit_length()) if LEAST <= 1 << k < size]
    jumps: dict[int, list[int]] = {}
    for p in powers:
        at = np.searchsorted(pos, pos - p)
        for j in np.flatnonzero(pos[at] == pos - p).tolist():
            jumps.setdefault(j, []).append(int(at[j]))
    p, c = pos.tolist(), cost.tolist()
    best, back, key = [0] * n, [0] * n, [0] * n  # key: best + position
    key[0] = p[0]
    queue: deque[int] = deque([0])  # cuts in the window, with rising keys
    jump = jumps.get
    for j in range(1, n):
        here = p[j]
        i = queue[0]
        while here - p[i] > size:
            queue.popleft()
            i = queue[0]
        total = key[i] + size - here
        if found := jump(j):
            for k in found:
                if best[k] < total:
                    total, i = best[k], k
        total += c[j]
        best[j], back[j] = total, i
        key[j] = total = total + here
        while queue and key[queue[-1]] >= total:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def cut_points(sizes: np.ndarray, sentence_ends: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Positions and costs of the allowed cuts in a stream of documents; 0 comes first."""
    ends = np.cumsum(sizes)
    pos = np.sort(np.concatenate(([0], sentence_ends, ends)), kind="stable")  # of three rising runs
    pos = pos[np.append(True, np.diff(pos) > 0)]
    gaps = np.diff(pos)
    wide = np.flatnonzero(gaps > 2 * step)
    more = [np.arange(pos[i] + step, pos[i + 1], step) for i in wide.tolist()]
    hard = np.concatenate(more) if more else np.empty(0, np.int64)
    everything = np.concatenate((pos, hard))
    cost = np.concatenate((np.full(len(pos), SENTENCE), np.full(len(hard), HARD)))
    cost[np.searchsorted(pos, ends)] = 0
    cost[0] = 0
    order = np.argsort(everything, kind="stable")
    return everything[order], cost[order]


class Packer:
    """Takes documents in order and gives the pieces of finished windows; only an open window waits."""

    def __init__(self, size: int, first: int) -> None:
        self.size, self.sequence = size, first
        self.docs: list[tuple] = []  # (doc_id, ids, start within the document, its tokens)
        self.ends: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: object, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.ends.append(ends)
        self.waiting += len(ids)
        if self.waiting >= CHUNK:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        sizes = np.array([len(d[1]) for d in self.docs], np.int64)
        offsets = np.cumsum(sizes) - sizes
        pos, cost = cut_points(sizes, np.concatenate([e + o for e, o in zip(self.ends, offsets, strict=True)]))
        cuts = [0, *pos[best_cuts(pos, cost, self.size)].tolist()]
        if last:
            cuts[-2:] = self.tail(cuts[-2], cuts[-1])
        else:
            cuts.pop()
        doc = 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = a
            while at < b:
                while offsets[doc] + sizes[doc] <= at:
                    doc += 1
                doc_id, ids, start, total = self.docs[doc]
                low = at - int(offsets[doc])
                high = min(int(sizes[doc]), b - int(offsets[doc]))
                yield doc_id, start + low, high - low, zlib.crc32(ids[low:high].astype("<u4").tobytes()), total, self.sequence, at - a
                at += high - low
            self.sequence += 1
        rest = cuts[-1]
        docs, ends = [], []
        for (doc_id, ids, start, total), e, o, n in zip(self.docs, self.ends, offsets.tolist(), sizes.tolist(), strict=True):
            if not last and o + n > rest:
                gone = max(0, rest - o)
                docs.append((doc_id, ids[gone:], start + gone, total))
                ends.append(e[e > gone] - gone)
        self.docs, self.ends, self.waiting = docs, ends, sum(len(d[1]) for d in docs)

    def tail(self, a: int, b: int) -> list[int]:
        """The stream's last window, whole or in powers of two, whichever costs less."""
        n = b - a
        if n & (n - 1) == 0 or (n.bit_count() - 1) * HARD >= self.size - n:
            return [a, b]
        cuts = [a]
        for k in range(n.bit_length() - 1, -1, -1):
            if n >> k & 1:
                cuts.append(cuts[-1] + (1 << k))
        return cuts


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Order is that of the rows in each task and no row moves: there is no shuffle.  A null or empty text
    is its end id alone; null ids and repeated rows are packed like others (repeated rows as documents of
    their own); ids of any size are exact.  A very long text is cut over as many sequences as it fills and
    takes memory for its ids.  Of packings that cost the same, the one whose last cut comes first.  An empty
    table gives no piece.  Other columns, whatever their names, are neither read nor kept.  Sequence numbers
    are unique, with the task in the upper bits.
    """
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordTokenizer(tokenizer_path)
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        frame = lambda rows: frame_of(rows, names, ("doc_id",))
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the caches are large
        try:
            for pdf in batches:
                rows: list[tuple] = []
                for doc_id, ids in zip(exact_ids(pdf["doc_id"]), words.encode(pdf["text"].tolist()), strict=True):
                    ends = np.flatnonzero(words.ends[ids]) + 1
                    rows += packer.add(doc_id, np.concatenate((ids, np.array([END_ID], np.uint32))), ends)
                    if len(rows) > 20_000:
                        yield frame(rows)
                        rows = []
                yield frame(rows)
            yield frame(list(packer.flush(True)))
        finally:  # also when the task ends early: the worker is used again
            if collecting:
                gc.enable()
            del words
            trim()

    return map_slices(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, SCHEMA, rows=1000)
