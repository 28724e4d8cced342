"""Toxicity scores by a counterfactually regularised linear classifier.

A text's features are its words, lower-cased, and the first four to seven characters of longer words
(present or not), so that inflected forms of a word count together.  The classifier is a logistic
regression over the features whose document frequencies differ most between the classes, and the identity
terms.  Every labelled sentence with an identity term gets a twin in which the term is swapped for the next
of its group; a text without any lends a sentence in which a term is mentioned and then swapped or left
out.  The squared difference of the two scores is penalised, so that a group's mention alone moves no score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import exact_ids, map_slices, stored

#: Groups of identity terms; a term's counterfactual is the next one of its row (own choice, extensible).
IDENTITY_TERMS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"),
    ("black", "white", "asian", "latino"), ("muslim", "christian", "jewish", "hindu", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("immigrant", "native"), ("disabled", "healthy"), ("old", "young"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("musulmán", "cristiano", "judío"),
    ("femme", "homme"), ("femmes", "hommes"), ("musulman", "chrétien", "juif"),
    ("frau", "mann"), ("frauen", "männer"), ("muslimisch", "christlich", "jüdisch"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)}

TERMS = tuple(SWAP)

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
PREFIXES = (4, 5, 6, 7)
#: At most this many labelled rows, half of them for each class, are read to fit; row weights restore the classes' shares.
MAX_LABELLED = 6_000
MAX_FEATURES = 512
#: At most this many counterfactual pairs, chosen by a hash, take part in the fit.
MAX_PAIRS = 12_000
FAIRNESS = 10.0
CACHE = 300_000


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if isinstance(text, str) else set()


def code(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"))


def codes_of(word: str) -> list[int]:
    return [code(word), *(code(f"{word[:n]}*") for n in PREFIXES if len(word) > n)]


class Model:
    """Weights by feature code; fixed size, whatever the corpus."""

    def __init__(self, weights: dict[int, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[str, tuple[int, ...]] = {}

    def active(self, word: str) -> tuple[int, ...]:
        if len(self.known) > CACHE:
            self.known.clear()
        self.known[word] = found = tuple(c for c in codes_of(word) if c in self.weights)
        return found

    def score(self, text: str | None) -> float:
        known, active = self.known, self.active
        found = {c for x in words_of(text) for c in (known[x] if x in known else active(x))}
        z = self.bias + sum(self.weights[c] for c in sorted(found))
        return 1.0 / (1.0 + np.exp(-z))


def swapped(words: list[str]) -> list[str] | None:
    """A sentence's words with one identity term swapped for the next of its group: the first; None if there is no term."""
    for i, w in enumerate(words):
        if (other := SWAP.get(w.lower())) is not None:
            return [*words[:i], other, *words[i + 1 :]]
    return None


def counterfactuals(text: str | None, key: int) -> Iterator[tuple[set[str], set[str]]]:
    """Pairs of word sets whose scores should be equal, from the sentences of a labelled text.

    Every sentence with an identity term gives itself and its swapped twin.  A text without any term lends
    one sentence, in which a term of a group is mentioned: with it, without it, and with the next of the group.
    """
    sentences = [w for s in SENTENCE.split(text) if (w := WORD.findall(s))] if isinstance(text, str) else []
    found = False
    for words in sentences:
        if (twin := swapped(words)) is not None:
            found = True
            yield {w.lower() for w in words}, {w.lower() for w in twin}
    if sentences and not found:
        base = {w.lower() for w in sentences[key % len(sentences)]}
        term = TERMS[key // 7 % len(TERMS)]
        yield base | {term}, base
        yield base | {term}, base | {SWAP[term]}


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def newton(x: np.ndarray, y: np.ndarray, heavy: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], start: np.ndarray, ridge: float, fairness: float, rounds: int) -> np.ndarray:
    """Weights that minimise log loss + ridge * |w|^2 / 2 + fairness * sum (score - twin's score)^2 / 2; the last is the bias.

    Steps of Newton's method, of Gauss and Newton for the penalty, halved until the sum falls.
    """
    left, right = pairs
    held = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)

    def value(w: np.ndarray) -> float:
        z = np.clip(x @ w, -30, 30)
        return float((heavy * (np.logaddexp(0, z) - y * z)).sum() + (held * w * w).sum() / 2 + fairness * ((logistic(left @ w) - logistic(right @ w)) ** 2).sum() / 2)

    w, now = start, value(start)
    for _ in range(rounds):
        q, p, r = logistic(x @ w), logistic(left @ w), logistic(right @ w)
        slope = left * (p * (1 - p))[:, None] - right * (r * (1 - r))[:, None]
        hessian = (x * (heavy * q * (1 - q))[:, None]).T @ x + fairness * slope.T @ slope + np.diag(held)
        step = np.linalg.solve(hessian, x.T @ (heavy * (y - q)) - fairness * slope.T @ (p - r) - held * w)
        size = 1.0
        while size > 1e-4 and (then := value(w + size * step)) > now:
            size /= 2
        if size <= 1e-4:
            break
        w, gain, now = w + size * step, now - then, then
        if gain < 1e-9 * (1 + abs(now)):
            break
    return w


def matrix(rows: list[bytes], chosen: np.ndarray) -> np.ndarray:
    """0 and 1 for each row (packed positions in ``chosen``) and feature, and a column of ones."""
    out = np.zeros((len(rows), len(chosen) + 1))
    out[:, -1] = 1
    for i, r in enumerate(rows):
        out[i, np.frombuffer(r, "<u2")] = 1
    return out


def fit(rows: list[bytes], labels: np.ndarray, pairs: list[tuple[bytes, bytes]], chosen: np.ndarray, shares: tuple[float, float] | None = None, ridge: float = 0.3, fairness: float = FAIRNESS, rounds: int = 40) -> Model:
    """Fit the model on rows and counterfactual pairs, both as positions of their features in ``chosen``.

    ``shares`` are the classes' shares (0, 1) among all labels, for which rows are weighted.
    Without labels of both classes only the bias is fitted.
    """
    n, bad = len(rows), int((labels == 1).sum())
    prior = (bad + 0.5) / (n + 1.0) if shares is None else min(max(shares[1], 1e-3), 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    if not bad or bad == n:
        return Model({}, bias)
    y = (labels == 1).astype(float)
    heavy = np.where(labels == 1, prior * n / bad, (1 - prior) * n / (n - bad))
    twins = matrix([a for a, _ in pairs], chosen), matrix([b for _, b in pairs], chosen)
    w = newton(matrix(rows, chosen), y, heavy, twins, np.append(np.zeros(len(chosen)), bias), ridge, fairness, rounds)
    return Model({int(c): float(round(v, 9)) for c, v in zip(chosen, w[:-1], strict=True) if round(v, 9)}, float(round(w[-1], 9)))


def sampled(labels: DataFrame, label_col: str, max_labelled: int) -> tuple[DataFrame, dict[bool, int]]:
    """(doc_id, label) of at most ``max_labelled`` labelled rows outside the held-out fold, half of them for each class, chosen by a hash of the id; and all classes' counts."""
    named = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")).where("doc_id is not null and label is not null").where(~held_out())
    named = named.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r[0]: r[1] for r in named.groupBy((F.col("label") == 1).alias("toxic")).count().collect()}
    rows = [r for bad in (True, False) for r in named.where((F.col("label") == 1) == bad).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled // 2).collect()]
    return labels.sparkSession.createDataFrame([(r[0], int(r[1] == 1)) for r in rows], "doc_id long, label int"), counts


def strongest(used: DataFrame, n: tuple[int, int], features: int) -> np.ndarray:
    """Codes of the features whose document frequencies differ most between the classes, and of all identity terms, in order.

    Frequencies are counted in tasks and added up by code; only the chosen codes reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [np.unique(np.array([c for w in words_of(t) for c in codes_of(w)], np.int64)) for t in pdf["text"]]
            codes, index = np.unique(np.concatenate(own), return_inverse=True)
            heavy = np.repeat(pdf["label"].to_numpy(bool), [len(o) for o in own])
            bad = np.bincount(index, heavy, len(codes)).astype(np.int64)
            yield pd.DataFrame({"code": codes, "bad": bad, "good": np.bincount(index, minlength=len(codes)) - bad})

    bad, good = (float(max(1, m)) for m in (n[1], n[0]))
    counts = map_slices(used, count, "code long, bad long, good long").groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    p = (F.col("bad") + F.col("good")) / (bad + good)
    z = (F.col("bad") / bad - F.col("good") / good) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / bad + 1 / good))
    top = counts.where(F.col("bad") + F.col("good") >= 3).select("code", F.round(F.abs(z), 9).alias("z")).where("z >= 4").orderBy(F.desc("z"), "code").limit(features)
    return np.array(sorted({r[0] for r in top.collect()} | {code(t) for t in TERMS}), np.int64)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_pairs: int = MAX_PAIRS, features: int = MAX_FEATURES, **options: float) -> Model:
    """Fit on a bounded sample of labelled rows and of counterfactual pairs of their sentences.

    What reaches the driver is bounded in bytes: at most MAX_FEATURES codes, ``max_labelled`` rows and
    ``max_pairs`` pairs, each as positions of the chosen features that it has.
    """
    sample, counts = sampled(labels, label_col, max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    used = stored(texts, "labelled")  # repeated ids: the least of their texts
    n = {r[0]: r[1] for r in used.groupBy("label").count().collect()}
    if not n:
        return Model({}, 0.0)
    chosen = strongest(used, (n.get(0, 0), n.get(1, 0)), features)
    place = {int(c): i for i, c in enumerate(chosen)}

    def pack(words: set[str]) -> bytes:
        return np.array(sorted({place[c] for w in words for c in codes_of(w) if c in place}), "<u2").tobytes()

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, label, text in zip(exact_ids(pdf["doc_id"]), pdf["label"], pdf["text"], strict=True):
                key = zlib.crc32(str(doc_id).encode())
                out.append((doc_id, -1, label, pack(words_of(text)), None))
                out += [(doc_id, i, None, pack(a), pack(b)) for i, (a, b) in enumerate(counterfactuals(text, key))]
            yield pd.DataFrame(out, columns=["doc_id", "at", "label", "a", "b"]).astype({"label": "Int64"})

    packed = stored(map_slices(used, extract, "doc_id long, at long, label long, a binary, b binary", rows=200), "features")
    rows = packed.where("at < 0").orderBy("doc_id").collect()
    twins = packed.where("at >= 0 and a <> b").orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").limit(max_pairs).collect()
    total = sum(counts.values())
    shares = counts.get(False, 0) / total, counts.get(True, 0) / total
    return fit([bytes(r["a"]) for r in rows], np.array([r["label"] for r in rows]), [(bytes(r["a"]), bytes(r["b"])) for r in twins], chosen, shares, **options)


def held_out():  # noqa: ANN201
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, **options: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts get the score of a text without features.  Null ids are scored and not held out; ids
    of any size are exact.  Repeated rows get equal scores; of a labelled id with several texts the least
    trains, of its labels the largest.  A very long text is scored whole.  A score equal to the threshold is
    predicted 1.  Without labels every score is one half; an empty table gives an empty result.  Other
    columns, whatever their names, are not read.
    """
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    model = train(docs, labels, label_col, **options)
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(weights, bias)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": [round(float(own.score(t)), 9) for t in pdf["text"]]})

    scored = map_slices(docs, run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
