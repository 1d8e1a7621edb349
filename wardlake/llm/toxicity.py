"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a logistic model on the words of the text and on the chances that
the models before it gave. The labels know one category, toxic; the two before it are learnt from the labelled texts:
of the words that mark toxic documents, in whatever language, the most frequent ones, which hold half of all such finds,
make ``frequent``, the others ``rarer`` abuse. A later model is trained on out-of-fold chances: those of a model that has not seen the
document, as it will be with new documents. Features are words and word beginnings, so that a new form of a known
stem counts too; the vocabulary keeps those that tell toxic from clean documents.

Training runs on a bounded sample: the ``MAX_TRAINING`` labelled documents with the smallest hash of their id, of which
only the kept features of each reach the driver (at most MAX_FEATURES numbers a document). Every document is then scored
where it lies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import stage, text_of

MAX_TRAINING = 12_000
MAX_FEATURES = 4_000
LEAST_DOCUMENTS = 5
LEAST_CHI2 = 40.0
FOLDS = 3
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
#: A word marks abuse when this share of the labelled documents that hold it is toxic.
LEAST_SHARE = 0.5
CATEGORIES = ["frequent", "rarer", "toxic"]
_WORDS = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    return ["w:" + word, *("p:" + word[:k] for k in PREFIXES if len(word) >= k)]


def document_words(text: str) -> set[str]:
    return set(_WORDS.findall(text.lower()))


def fit(x: list[np.ndarray], extra: np.ndarray, y: np.ndarray, n_features: int, ridge: float = 1e-3,
        rounds: int = 400) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on sparse 0/1 rows ``x`` (feature numbers) and dense columns ``extra``: weights, their
    weights, bias. Full-batch gradient with momentum; positive and negative rows weigh the same in total."""
    row = np.repeat(np.arange(len(x)), [len(r) for r in x])
    col = np.concatenate(x) if len(x) else np.zeros(0, int)
    w, v, b = np.zeros(n_features), np.zeros(extra.shape[1]), 0.0
    if not len(y) or y.min() == y.max():
        return w, v, (-10.0 if not len(y) or y[0] == 0 else 10.0)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())
    mw, mv, mb = np.zeros_like(w), np.zeros_like(v), 0.0
    for _ in range(rounds):
        z = np.bincount(row, w[col], len(x)) + extra @ v + b
        d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        mw = 0.9 * mw + np.bincount(col, d[row], n_features) + ridge * w
        mv = 0.9 * mv + extra.T @ d + ridge * v
        mb = 0.9 * mb + d.sum()
        w, v, b = w - mw, v - mv, b - mb
    return w, v, b


def chances(model, x: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    w, v, b = model
    z = np.array([w[r].sum() for r in x]) + extra @ v + b if len(x) else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_cut(p: np.ndarray, y: np.ndarray, least: float = THRESHOLD) -> float:
    """The chance from ``least`` on at which calling a document toxic has the largest F1 on (p, y).

    Of cuts between two neighbouring chances that call the same documents toxic the middle one, of several with equal
    F1 the lowest. Without toxic documents it is ``least``.
    """
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    said = np.arange(1, len(p) + 1)
    f1 = 2 * np.cumsum(y) / (said + max(1, y.sum()))
    ends = np.append(p[1:] < p[:-1], True) & (p >= least) if len(p) else np.zeros(0, bool)
    if not ends.any() or not y.any():
        return least
    k = int(np.flatnonzero(ends & (f1 == f1[ends].max()))[-1])
    return max(least, (p[k] + (p[k + 1] if k + 1 < len(p) else least)) / 2)


class Chain:
    """The fitted chain: vocabulary, one model per category, and the last category's cut, from its out-of-fold chances."""

    def __init__(self, vocabulary: list[str], x: list[np.ndarray], labels: np.ndarray, fold: np.ndarray):
        self.at = {f: k for k, f in enumerate(vocabulary)}
        self.models = []
        n = len(vocabulary)
        extra = np.zeros((len(x), 0))
        for c in range(labels.shape[1]):
            y = labels[:, c].astype(float)
            self.models.append(fit(x, extra, y, n))
            out = np.zeros(len(x))
            for f in range(FOLDS):
                new = np.flatnonzero(fold == f)
                old = np.flatnonzero(fold != f)
                model = fit([x[k] for k in old], extra[old], y[old], n)
                out[new] = chances(model, [x[k] for k in new], extra[new])
            extra = np.column_stack([extra, out])
        self.out_of_fold = extra
        self.cut = best_cut(extra[:, -1], labels[:, -1])

    def rows(self, texts: list[str], known: dict[str, tuple[int, ...]]) -> list[np.ndarray]:
        out = []
        for t in texts:
            mine: set[int] = set()
            for w in document_words(t):
                ids = known.get(w)
                if ids is None:
                    ids = tuple(self.at[f] for f in features_of(w) if f in self.at)
                    if len(known) < 300_000:
                        known[w] = ids
                if ids:
                    mine.update(ids)
            out.append(np.fromiter(sorted(mine), int, len(mine)))
        return out

    def score(self, texts: list[str], known: dict[str, tuple[int, ...]]) -> np.ndarray:
        x = self.rows(texts, known)
        extra = np.zeros((len(x), 0))
        for m in self.models:
            extra = np.column_stack([extra, chances(m, x, extra)])
        return extra


def marking_words(counts: list[tuple[str, int, int]]) -> tuple[set[str], set[str]]:
    """The words of the first two categories, from (feature, clean documents, toxic documents) of the vocabulary.

    Ties of the number of toxic documents go by the word. Without such words both sets are empty, and these categories
    are never predicted.
    """
    marks = sorted((-t, f) for f, c, t in counts if f.startswith("w:") and t >= LEAST_SHARE * (c + t))
    half, seen, frequent = -sum(t for t, _ in marks) / 2, 0, set()
    for t, f in marks:
        if seen < half:
            frequent.add(f)
        seen -= t
    return frequent, {f for _, f in marks} - frequent


def category_labels(x: list[np.ndarray], toxic: np.ndarray, vocabulary: list[str],
                    words: tuple[set[str], set[str]]) -> np.ndarray:
    """0/1 per document and category: toxic documents that hold a word of a category, and the label itself."""
    marks = [np.array([f in w for f in vocabulary], bool) for w in words]
    return np.array([[*(int(t and m[r].any()) for m in marks), t] for r, t in zip(x, toxic)], int).reshape(len(x), len(CATEGORIES))


def _distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            for f in {f for w in document_words(text) for f in features_of(w)}:
                counts.setdefault(f, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts)), pa.array([c for c, _ in counts.values()], pa.int64()),
             pa.array([t for _, t in counts.values()], pa.int64())], names=["feature", "clean", "toxic"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
          most: int = MAX_TRAINING) -> Chain:
    """Fit the chain. Labels that are null, other than 0 or 1, or of no document are left out; of rows that
    repeat an id, the largest label and the text that sorts first count, so the sample stays bounded."""
    one = labels.select(F.col(id_col).alias("doc_id"), F.col(toxic_col).cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most ``most`` short rows: this side may be broadcast at any size of the table
    sample = stage(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "toxic-sample")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = stage(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "toxic-texts")
    seen = rows.select("text", "toxic").mapInArrow(_distinct_features, "feature string, clean long, toxic long").groupBy(
        "feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = rows.agg(F.count("*"), F.sum("toxic")).first()
    n, pos = float(size[0]), float(size[1] or 0)
    if not n:
        return Chain([], [], np.zeros((0, len(CATEGORIES))), np.zeros(0, int))
    df = F.col("clean") + F.col("toxic")
    gap = F.col("toxic") * F.lit(n) - df * F.lit(pos)
    chi2 = gap * gap / (df * (F.lit(n) - df + F.lit(1.0)) * F.lit(max(1.0, pos * (n - pos)) / n))
    best = seen.filter(df >= LEAST_DOCUMENTS).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2).orderBy(
        F.desc("chi2"), "feature").limit(MAX_FEATURES).select("feature", "clean", "toxic").collect()
    vocabulary = [r["feature"] for r in best]
    empty = Chain.__new__(Chain)
    empty.at = {f: k for k, f in enumerate(vocabulary)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            x = empty.rows(b.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(x, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(vectors, f"doc_id {kind}, toxic int, x array<int>").withColumn(
        "fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS))).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    x = [np.array(r["x"], int) for r in got]
    words = marking_words([(r["feature"], r["clean"], r["toxic"]) for r in best])
    y = category_labels(x, np.array([r["toxic"] for r in got]), vocabulary, words)
    return Chain(vocabulary, x, y, np.array([r["fold"] for r in got]))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float | None = None) -> DataFrame:
    """doc_id, the chance of each category, and is_toxic (at ``threshold``, else the chain's cut), for every row of ``docs``.

    A null or empty text has no features and gets the chances of a text without any. Rows that repeat are
    scored each; an empty table gives no rows; other columns are not read.
    """
    cut = chain.cut if threshold is None else threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                p = chain.score(part.column("text").to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(p[:, c]) for c in range(p.shape[1])), pa.array(p[:, -1] >= cut)],
                    names=["doc_id", *(f"p_{c}" for c in CATEGORIES), "is_toxic"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'p_{c} double' for c in CATEGORIES)}, is_toxic boolean")
