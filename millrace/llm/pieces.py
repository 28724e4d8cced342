"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words before every run of spaces, as no piece has a space after another character;
each distinct word is encoded once.  The words' symbols stand in one flat array, in which words are cut
further where no piece holds the two characters.  In a round every part finds its best rank with one
segmented minimum, all parts merge their leftmost pairs of that rank at once, and the array is compacted.
Parts without a pair leave; the rounds end when none is left.  Where a merge makes a pair that the
library's queue would take before the rest, the rest waits, so results are equal.  Words of any length
take this way: a text without spaces is one word, whose rounds are bounded by its distinct ranks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.common import map_slices

SPACE = "▁"
CACHE = 500_000
#: Characters beyond which a word is merged alone.
ALONE = 4096
SEGMENT = re.compile("▁+[^▁]*")
NONE = np.int64(1) << np.int64(62)

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message; groups don't occur."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + n]
            at += n


class PieceModel:
    """A BPE model file with byte fallback, identity normalisation and a space before the text."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[tuple[str, float, int]] = []
        for number, value in fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for k, v in fields(value):
                    if k == 1:
                        piece = v.decode("utf-8")
                    elif k == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif k == 3:
                        kind = v
                self.pieces.append((piece, score, kind))
        normal = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.bos = next(i for i, p in enumerate(self.pieces) if p[0] == "<s>" and p[2] == CONTROL)
        self.eos = next(i for i, p in enumerate(self.pieces) if p[0] == "</s>" and p[2] == CONTROL)
        self.bytes = np.zeros(256, np.int64)
        for i, (p, _, kind) in enumerate(self.pieces):
            if kind == BYTE:
                self.bytes[int(p[3:5], 16)] = i
        # Symbols: pieces have their ids; characters that are no piece get numbers from here on.
        self.symbols = dict(normal)
        for p in normal:
            for ch in p:
                self.symbols.setdefault(ch, len(self.pieces) + len(self.symbols))
        self.base = max(self.symbols.values()) + 1
        self.extra = {v: k for k, v in self.symbols.items() if v >= len(self.pieces)}
        order = np.unique([-s for _, s, _ in self.pieces])
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 21 | b] = (int(np.searchsorted(order, -self.pieces[i][1])), i)
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, NONE)
        self.ranks = np.array([*(pairs[k][0] for k in keys.tolist()), NONE], np.int64)
        self.merged = np.array([pairs[k][1] for k in keys.tolist()] + [0], np.int64)
        inside = {self.symbols[a] << 21 | self.symbols[b] for p in normal for a, b in zip(p, p[1:], strict=False)}
        self.inner = np.append(np.array(sorted(inside), np.int64), NONE)
        #: Two pieces' worth of characters: merges further apart than that don't meet in one round.
        self.reach = 2 * max(map(len, normal), default=1)
        self.rounds = 0
        self.run = SPACE * 3 * self.reach
        self.stride = self.space_stride()
        self.known: dict[str, bytes] = {}
        self.table = [b"" if kind in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in self.pieces]
        self.is_byte = np.array([kind == BYTE for _, _, kind in self.pieces])

    # ------------------------------------------------------------ encoding

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the keys, or the last one's where there is none."""
        key = left << 21 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    def joinable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece holds the two characters next to each other: no merge ever crosses a place where none does."""
        key = left << 21 | right
        return self.inner[np.searchsorted(self.inner, key)] == key

    def space_stride(self) -> int:
        """How many spaces each piece of a long run of them takes, or 0 if that isn't known.

        Where all pairs of spaces have one rank, worse than any other, they merge last and from the left: a
        piece is complete before the next one begins, and a long run may be cut after each.
        """
        at = {len(p): i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL and set(p) == {SPACE}}
        scores = {self.pieces[i][1] for n, i in at.items() if n > 1}
        if len(scores) != 1 or min(s for _, s, kind in self.pieces if kind == NORMAL) < max(scores):
            return 0
        size = lambda n: [len(self.pieces[i][0]) for i in self.merge(np.full(n, self.symbols[SPACE]), np.array([n]))[0].tolist()]
        runs = size(6 * self.reach)
        return runs[0] if set(runs[:-2]) == {runs[0]} and size(6 * self.reach - runs[0]) == runs[1:] else 0

    def merge(self, symbols: np.ndarray, sizes: np.ndarray, cuts: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words of a flat array of characters; the merged symbols and each word's number of them, in order.

        A word is cut into parts where no pair can join, and at ``cuts``.  In a round every part finds its best rank (a
        segmented minimum) and merges all leftmost pairs of that rank at once.  One merge can make a pair of
        the same or a better rank, which the library would take next; pairs to the right of it then wait for
        the next round, unless they lie further away than what two pieces can cover.
        """
        none = len(self.keys) - 1
        word = np.repeat(np.arange(len(sizes)), sizes)
        owner = np.zeros(len(symbols), np.int64)
        new = (word[1:] != word[:-1]) | ~self.joinable(symbols[:-1], symbols[1:])
        new[np.array(cuts, np.int64) - 1] = True
        owner[1:] = np.cumsum(new)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
        word_of = word[first]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(symbols), none)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair[inner] = self.lookup(symbols[inner], symbols[inner + 1])
        self.rounds = 0
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            rank = self.ranks[pair]
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            live = best != NONE
            if not live.all():
                alive = np.repeat(live, counts)
                done.append((owner[~alive], symbols[~alive]))
                owner, symbols, pair, rank = owner[alive], symbols[alive], pair[alive], rank[alive]
                best, counts = best[live], counts[live]
            if not len(symbols):
                break
            self.rounds += 1
            at = np.flatnonzero(rank == np.repeat(best, counts))
            # of pairs that overlap (runs of neighbouring positions, never across parts) every other one, leftmost first
            run = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])))
            begin = np.flatnonzero(run)
            at = at[(np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 0]
            made = self.merged[pair[at]]
            near = np.concatenate(([False], (at[1:] - at[:-1] <= self.reach) & (owner[at[1:]] == owner[at[:-1]])))
            if near.any():
                left = symbols[np.maximum(at - 1, 0)]
                touch = np.concatenate(([False], at[1:] == at[:-1] + 2))
                left[touch] = made[:-1][touch[1:]]
                right = symbols[np.minimum(at + 2, len(symbols) - 1)]
                at_left = np.where((at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at]), self.ranks[self.lookup(left, made)], NONE)
                at_right = np.where((at + 2 < len(owner)) & (owner[np.minimum(at + 2, len(owner) - 1)] == owner[at]), self.ranks[self.lookup(made, right)], NONE)
                again = np.minimum(at_left, at_right) <= rank[at]
                if again.any():
                    before = np.cumsum(again) - again
                    group = np.flatnonzero(~near)
                    keep = before - np.repeat(before[group], np.diff(np.append(group, len(at)))) == 0
                    at, made = at[keep], made[keep]
            symbols[at] = made
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol less for each earlier merge
            owner, symbols, pair = owner[keep], symbols[keep], pair[keep]
            for i, j in ((at, at + 1), (at - 1, at)):
                ok = (i >= 0) & (j < len(symbols))
                i, j = i[ok], j[ok]
                pair[i] = np.where(owner[i] == owner[j], self.lookup(symbols[i], symbols[j]), none)
            if len(at) and at[-1] + 1 == len(symbols):
                pair[at[-1]] = none
        owner = np.concatenate([d[0] for d in done]) if done else np.empty(0, np.int64)
        symbols = np.concatenate([d[1] for d in done]) if done else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(word_of[owner], minlength=len(sizes))

    def learn(self, words: list[str]) -> None:
        """Encode words and keep their ids; a long word is merged alone, so that its rounds don't hold up others."""
        strange: dict[int, str] = {}
        own: dict[str, int] = {}

        def symbol(ch: str) -> int:
            if (s := self.symbols.get(ch)) is None and (s := own.get(ch)) is None:
                s = own[ch] = self.base + len(own)
                strange[s] = ch
            return s

        for part in ([w for w in words if len(w) <= ALONE], *([w] for w in words if len(w) > ALONE)):
            flat = "".join(part)
            numbers = {ch: symbol(ch) for ch in set(flat)}
            cuts: list[int] = []
            if self.stride:
                begin = 0
                for w in part:
                    if w.startswith(self.run):
                        cuts += range(begin + self.stride, begin + len(w) - len(w.lstrip(SPACE)) - 2 * self.reach, self.stride)
                    begin += len(w)
            symbols, sizes = self.merge(np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat)), np.fromiter(map(len, part), np.int64, len(part)), cuts)
            data, ends = symbols.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
            odd = set(np.repeat(np.arange(len(part)), sizes)[symbols >= len(self.pieces)].tolist())
            start = 0
            for i, (w, end) in enumerate(zip(part, ends, strict=True)):
                self.known[w] = self.plain(np.frombuffer(data[start:end], "<u4"), strange) if i in odd else data[start:end]
                start = end

    def plain(self, found: np.ndarray, strange: dict[int, str]) -> bytes:
        """Ids of merged symbols: a character that is no piece becomes the pieces of its bytes."""
        ids: list[int] = []
        for x in found.tolist():
            ids += [x] if x < len(self.pieces) else self.bytes[list((self.extra.get(x) or strange[x]).encode("utf-8", "replace"))].tolist()
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids with begin and end id; a null text counts as empty."""
        ends = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        for at in range(0, len(texts), 256):
            part = [SEGMENT.findall((SPACE + t).replace(" ", SPACE)) if isinstance(t, str) and t else [] for t in texts[at : at + 256]]
            if len(self.known) > CACHE:
                self.known.clear()
            self.learn(list(set().union(*part).difference(self.known)))
            get = self.known.__getitem__
            for segments in part:
                yield np.frombuffer(b"".join([ends[0], *map(get, segments), ends[1]]), "<u4")

    # ------------------------------------------------------------ decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, runs of bytes as UTF-8 with U+FFFD for each byte that fits nowhere."""
        ids = ids[(ids != self.bos) & (ids != self.eos)]
        if not len(ids):
            return ""
        data = b"".join(map(self.table.__getitem__, ids.tolist()))
        if self.pieces[ids[0]][0].startswith(SPACE):
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            out, i = [], 0
            while i < len(data):
                first = data[i]
                n = 1 if first < 0x80 else 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 0
                try:
                    out.append(data[i : i + n].decode("utf-8") if n else "�")
                    i += n or 1
                except UnicodeDecodeError:
                    out.append("�")
                    i += 1
            return "".join(out)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of every row.

    Null and empty texts have the begin and end ids only.  Null ids and repeated rows are treated like
    others, and ids of any size are exact.  A very long text is encoded whole, in memory that grows with its
    distinct words.  Pairs of equal rank merge from the left.  An empty table gives an empty result; other
    columns, whatever their names, are not read.  No shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = PieceModel(model_path)
        for pdf in batches:
            out = []
            for ids in model.encode(pdf["text"].tolist()):
                decoded = model.decode(ids).encode("utf-8", "replace")
                out.append((len(ids), ids.astype(np.int64) if with_ids else None, hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            frame = pd.DataFrame(out, columns=["n_tokens", "ids", "ids_sha256", "decoded_sha256"])
            frame.insert(0, "doc_id", pdf["doc_id"].array)
            yield frame if with_ids else frame.drop(columns="ids")

    schema = "doc_id long, n_tokens long, ids array<long>, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, schema if with_ids else schema.replace("ids array<long>, ", ""))
