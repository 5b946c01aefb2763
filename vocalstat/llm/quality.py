"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text (``FEATURES``) are computed in one pass, in Arrow batches. Trees are
grown on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hashes of doc_id, whose
statistics are the only rows that reach the driver. A feature is cut into ``BINS`` bins at its
quantiles; a level of a tree needs one histogram of gradients a feature. The trees are complete,
of one depth, and are kept as arrays of features, limits and leaf values, so that scoring walks
all rows of a batch down a tree by array indexing.

Labels are learned only from rows whose crc32 of doc_id as text isn't a multiple of five.

Defined cases: null counts as empty, and the empty text has statistics of zero and a score like
any other; an id labelled twice counts as good if either label is; rows without id or label are
not learned from; without labels every score is 0.5, with one class only it is near that class;
equal texts have equal scores; empty tables give empty results; further columns are not read (in
the pipeline's stage they are kept).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import load, map_rows, whole_text

TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LIMIT = 0.3
FOLDS = 5

#: Classes of bytes whose share is a statistic.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\r\x0b\x0c", "bang": b"!?",
           "stop": b".,;:", "bar": b"|", "mark": b"#$%&*@^~=<>{}[]\\_+", "quote": b"\"'`()-/", "high": bytes(range(128, 256))}
_MASKS = np.array([np.isin(np.arange(256), np.frombuffer(c, np.uint8)) for c in CLASSES.values()], float)
FEATURES = ("chars", "words", "lines", *CLASSES, "entropy", "word_len", "long_words", "short_words", "distinct", "top_word",
            "top_three", "repeats", "line_len", "same_lines", "capital_words", "marked_words")


def statistics(text: str) -> list[float]:
    """The features of a whole text."""
    b = text.encode("utf-8", "surrogatepass")
    if not b:
        return [0.0] * len(FEATURES)
    n = np.bincount(np.frombuffer(b, np.uint8), minlength=256).astype(float)
    share = n[n > 0] / len(b)
    words, lines = b.split(), [x for x in b.split(b"\n") if x]
    seen, w, k = Counter(words), max(1, len(words)), max(1, len(lines))
    top = [c for _, c in seen.most_common(3)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    repeats = sum(x == y for x, y in zip(words, words[1:]))
    capital = sum(c for x, c in seen.items() if x.isupper())
    marked = sum(c for x, c in seen.items() if not x[-1:].isalnum() and x[-1] < 128)
    return [np.log1p(len(b)), np.log1p(len(words)), np.log1p(len(lines)), *(_MASKS @ n / len(b)),
            float(-(share * np.log(share)).sum()), float(lengths.sum() / w), float((lengths > 15).sum() / w), float((lengths < 4).sum() / w),
            len(seen) / w, sum(top[:1]) / w, sum(top) / w, repeats / w, np.log1p(len(b) / k), 1.0 - len(set(lines)) / k, capital / w, marked / w]


@dataclass
class Trees:
    """Complete trees as arrays: (trees, inner nodes) features and limits, (trees, leaves) values."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += leaf[at - inner]
        return 1.0 / (1.0 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost on the logistic loss; a level's best cuts come from histograms of all its nodes at once."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y):
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS, method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    feature, limit = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf, raw = np.zeros((trees, leaves)), np.full(len(y), start)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        g, h, at = p - y, p * (1.0 - p), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best, node = np.full(width, 1e-6), at - first
            for f in range(x.shape[1]):
                key = node * BINS + binned[:, f]
                gs = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt ** 2 / (ht + RIDGE)
                gain = gain[:, :len(cuts[f])]
                if gain.shape[1]:
                    cut = gain.argmax(axis=1)
                    value = gain[np.arange(width), cut]
                    for k in np.nonzero(value > best)[0]:
                        best[k], feature[t, first + k], limit[t, first + k] = value[k], f, cuts[f][cut[k]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > limit[t, at])
        own = at - inner
        leaf[t] = -RATE * np.bincount(own, g, leaves) / (np.bincount(own, h, leaves) + RIDGE)
        raw += leaf[t][own]
    return Trees(feature, limit, leaf, start)


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Trees for the label, from at most ``rows`` of its rows that aren't held out."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max(label).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(own), "doc_id")  # `rows` ids at most
    known = map_rows(sample, lambda i, t, y: {"doc_id": i, "y": y, "x": [statistics(v) for v in t]},
                     "doc_id long, y double, x array<double>", "doc_id", "text", "y").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in known]).reshape(-1, len(FEATURES))
    return grow(x, np.array([r["y"] for r in known]))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(ids: list, texts: list) -> dict:
        x = np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))
        return {"doc_id": ids, "score": trees.score(x).tolist()}

    return map_rows(docs.select("doc_id", whole_text().alias("text")), run, "doc_id long, score double", "doc_id", "text")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that score at least ``LIMIT`` stay; columns as in ``docs``."""
    trees = train(docs, load(spark, sf_dir, "labels"))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or "") for t in batch.column(place).to_pylist()]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(trees.score(x) >= LIMIT))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, over the whole ``documents``."""
    docs = load(spark, sf_dir, "documents")
    s = score(docs, train(docs, load(spark, sf_dir, "labels")))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
