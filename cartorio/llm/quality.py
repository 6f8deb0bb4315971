"""Quality: a generalised additive model with pairwise interactions over surface features of whole texts.

Every feature is cut into quantile bins. Boosting goes round the features in turn; each turn fits a shallow tree on
one feature's bins to the current gradient and adds its leaves to that feature's lookup table. Pairs of features are
then ranked by how much a small tree on both would still gain, and the best pairs get tables in the same cyclic way.
A score is the intercept plus one table entry for each feature and pair: vectorised bin look-ups and additions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean
from cartorio.llm.labelled import fold, sample
from cartorio.llm.text import Words, chunks, mix, utf8

#: Labelled texts that a fit uses at most.
MOST_ROWS = 12_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6

_CLASS = np.full(256, 6)  # 0 upper, 1 lower, 2 digit, 3 blank, 4 line feed, 5 sentence mark, 6 other ASCII, 7 beyond ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[32, 9, 13]], _CLASS[10], _CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 3, 4, 5
FEATURES = ("log_bytes", "upper", "lower", "digit", "blank", "line_feed", "mark", "symbol", "wide", "word_length", "distinct",
            "short_words", "long_words", "line_length", "same_line", "same_pair")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; an empty text has zeros."""
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    doc = np.repeat(np.arange(rows), np.diff(offsets))
    kinds = np.bincount(doc * 8 + _CLASS[data], minlength=rows * 8).reshape(rows, 8)
    per = np.maximum(size, 1)
    words = Words(data, offsets)
    n = words.counts
    some = np.maximum(n, 1)
    length = words.end - words.start
    count = lambda at: np.bincount(at, minlength=rows)
    seed = mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))

    def different(value: np.ndarray, at: np.ndarray) -> np.ndarray:
        _, one = np.unique(value ^ seed[at], return_index=True)
        return count(at[one])

    pair, place = words.shingles(2)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.r_[offsets[:-1][size > 0], breaks + 1])
    starts = starts[starts < len(data)]
    line_doc = doc[starts] if len(starts) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(data)] if len(starts) else starts
    # A line's content by the hashes of its words: their running sum between the line's ends.
    hashes = np.r_[np.uint64(0), np.cumsum(words.hash)]
    content = hashes[np.searchsorted(words.start, ends)] - hashes[np.searchsorted(words.start, starts)]
    lines = np.maximum(count(line_doc), 1)
    return np.stack([
        np.log1p(size), *(kinds[:, k] / per for k in range(8)), np.bincount(words.doc, length, rows) / some,
        different(words.hash, words.doc) / some, count(words.doc[length <= 2]) / some, count(words.doc[length >= 12]) / some,
        np.log1p(size / lines), 1 - different(content, line_doc) / lines,
        1 - different(pair, words.doc[place]) / np.maximum(count(words.doc[place]), 1)], 1)


@dataclass
class Model:
    """edges[f]: cut points; tables[f]: one value a bin; pairs: (f, g, edges of f, edges of g, table)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, f])]
        for f, g, e, h, t in self.pairs:
            z += t[np.searchsorted(e, x[:, f]), np.searchsorted(h, x[:, g])]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """(gain, bins on the left) of the best split of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    ga, ha = g.sum(), h.sum()
    gain = a**2 / (b + ridge) + (ga - a) ** 2 / (ha - b + ridge) - ga**2 / (ha + ridge)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree of a few leaves on one feature's bins: each bin's value."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max((*_best_cut(g[lo:hi], h[lo:hi], ridge), i) for i, (lo, hi) in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts.pop(k)
        parts += [(lo, lo + at), (lo + at, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """(gain, table) of the best tree that cuts the first feature once, and then each side once by the second."""
    a, b = np.cumsum(g, 0)[:-1], np.cumsum(h, 0)[:-1]

    def side(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.cumsum(p, 1), np.cumsum(q, 1)
        gain = x[:, :-1] ** 2 / (y[:, :-1] + ridge) + (x[:, -1:] - x[:, :-1]) ** 2 / (y[:, -1:] - y[:, :-1] + ridge)
        return gain.max(1), gain.argmax(1)

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    (up, cut_up), (down, cut_down) = side(a, b), side(g.sum(0) - a, h.sum(0) - b)
    k = int((up + down).argmax())
    out = np.zeros_like(g)
    for rows, cut in ((slice(0, k + 1), int(cut_up[k]) + 1), (slice(k + 1, None), int(cut_down[k]) + 1)):
        for cols in (slice(0, cut), slice(cut, None)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return float(up[k] + down[k] - g.sum() ** 2 / (h.sum() + ridge)), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, leaves: int = 3, ridge: float = 1.0) -> Model:
    y = np.asarray(y, float)
    share = float(y.mean()) if len(y) else 1.0
    edges = [_cuts(x[:, f], BINS) if len(x) else np.zeros(0) for f in range(len(FEATURES))]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not 0 < share < 1:
        return Model(60.0 if share else -60.0, edges, tables, [])
    intercept = float(np.log(share / (1 - share)))
    bins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]
    z = np.full(len(y), intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f, b in enumerate(bins):
            g, h = gradient()
            step = rate * _tree(np.bincount(b, g, len(tables[f])), np.bincount(b, h, len(tables[f])), leaves, ridge)
            tables[f] += step
            z += step[b]
    coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(len(FEATURES))]
    wide = [len(c) + 1 for c in coarse]
    small = [np.searchsorted(c, x[:, f]) for f, c in enumerate(coarse)]

    def pair_sums(f: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = small[f] * wide[k] + small[k]
        return tuple(np.bincount(at, v, wide[f] * wide[k]).reshape(wide[f], wide[k]) for v in gradient())

    ranked = sorted(combinations(range(len(FEATURES)), 2), key=lambda p: -_pair_tree(*pair_sums(*p), ridge)[0])[:PAIRS]
    pair_tables = [np.zeros((wide[f], wide[k])) for f, k in ranked]
    for _ in range(rounds // 3):
        for (f, k), t in zip(ranked, pair_tables, strict=True):
            step = rate * _pair_tree(*pair_sums(f, k), ridge)[1]
            t += step
            z += step[small[f], small[k]]
    return Model(intercept, edges, tables, [(f, k, coarse[f], coarse[k], t) for (f, k), t in zip(ranked, pair_tables, strict=True)])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", held_out: int = 0, folds: int = 5, most: int = MOST_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most `most` labelled documents whose id's fold isn't held out; only their features reach the driver. An id
    with two labels has the larger; rows that repeat an id count each. Without both classes every score is the class's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(0))
            for lo, hi in chunks(offsets):
                x = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), b.column(1).slice(lo, hi - lo)], [*FEATURES, "label"])

    rows = sample(docs, labels, label_col, fold("_id", folds) != held_out, most, id_col, text_col).mapInArrow(
        run, ", ".join(f"{f} double" for f in FEATURES) + ", label int").toPandas().sort_values([*FEATURES, "label"])
    return fit(rows[list(FEATURES)].to_numpy(), rows["label"].to_numpy())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text, however long; null and empty texts are scored by their zero features. Each row is scored
    by itself: repeated rows get equal scores, null ids stay, no rows give none. Only the two named columns are read."""
    shared = lean(docs).sparkSession.sparkContext.broadcast((model.intercept, model.edges, model.tables, model.pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets):
                x = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(model.scores(x))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, score double").withColumnRenamed("id", id_col)
