"""Toxicity: embeddings of character n-grams, averaged over short runs of words into a linear softmax.

The plain average over the whole text (run=None) is there too; it misses more and flags more clean texts, as the README shows,
so runs are the default. A word's vector is the mean of its n-grams' vectors, so that unseen misspellings share most of them. A run of a few
words has the mean of its words' vectors and goes through a linear softmax with two classes; a text's evidence is the
log-sum of its runs' evidence, so that one insult counts alike in ten words and in ten thousand. Vectors and softmax
are trained jointly in numpy by Adam, on a bounded sample of labelled texts. Once trained, the log-odds of a run are
linear in its n-grams, so scoring needs one number for each n-gram bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean
from cartorio.llm.labelled import fold, sample
from cartorio.llm.text import BASE, Words, chunks, mix, utf8

#: Labelled texts that a fit uses at most, and bytes of text that the driver is sent for it.
MOST_ROWS, MOST_BYTES = 12_000, 64 << 20
BUCKETS, DIMENSIONS, GRAMS, RUN = 1 << 17, 8, (3, 4, 5, 6), 2


def gram_buckets(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row in `chosen`) of each n-gram of the chosen words, with < and > at their ends."""
    start, end = words.start[chosen], words.end[chosen]
    size = end - start + 2
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(chosen)), size)
    inner = np.arange(len(owner)) - first[owner]
    data = np.full(len(owner), 60, np.uint64)
    data[first + size - 1] = 62
    body = (inner > 0) & (inner < size[owner] - 1)
    data[body] = words.data[(start[owner] + inner - 1)[body]]
    buckets, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.zeros(len(data) - n + 1, np.uint64)
        for j in range(n):
            h = h * BASE + data[j : len(data) - n + 1 + j]
        same = owner[: len(h)] == owner[n - 1 :]
        buckets.append((mix(h[same] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[: len(h)][same])
    return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def run_means(values: np.ndarray, first: np.ndarray, run: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mean, first word, words) of each run of `run` words, or of a shorter row's all, and the runs of each row; rows are
    first[r]:first[r+1]. None: each row is one run."""
    total = np.r_[0.0, np.cumsum(values)]
    counts = np.diff(first)
    runs = np.where(counts > 0, 1 if run is None else np.maximum(counts - run + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), runs)
    begin = first[:-1][row] + np.arange(len(row)) - (np.cumsum(runs) - runs)[row]
    words = counts[row] if run is None else np.minimum(run, counts[row])
    return (total[begin + words] - total[begin]) / words, begin, words, runs


def log_sums(z: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of the sum of exp over each row's runs (-inf for none), and each run's share of it."""
    out, share = np.full(len(runs), -np.inf), np.zeros(len(z))
    some = runs > 0
    if some.any():
        at = (np.cumsum(runs) - runs)[some]
        top = np.maximum.reduceat(z, at)
        e = np.exp(z - np.repeat(top, runs[some]))
        s = np.add.reduceat(e, at)
        out[some] = top + np.log(s)
        share = e / np.repeat(s, runs[some])
    return out, share


@dataclass
class Model:
    """log-odds = bias + log-sum over runs of the mean of their words' mean n-gram weights."""

    weight: np.ndarray
    bias: float
    run: int | None = RUN

    def scores(self, words: Words) -> np.ndarray:
        _, one, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        bucket, owner = gram_buckets(words, one)
        value = np.bincount(owner, self.weight[bucket], len(one)) / np.maximum(np.bincount(owner, minlength=len(one)), 1)
        z, _, _, runs = run_means(value[inverse] if len(one) else np.zeros(0), words.first, self.run)
        pooled, _ = log_sums(z, runs)
        return 1 / (1 + np.exp(-np.clip(pooled + self.bias, -60, 60)))


class Sample:
    """Texts as numbers of distinct words, and the n-gram buckets of each distinct word: made once for all steps."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        hashes, grams, sizes, words, counts, known = [np.zeros(0, np.uint64)], [], [], [], [], np.zeros(0, np.uint64)
        for lo, hi in chunks(offsets, 1 << 20):
            w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
            h, one = np.unique(w.hash, return_index=True)
            near = np.searchsorted(known, h)
            fresh = one[(near == len(known)) | (known[np.minimum(near, len(known) - 1)] != h)] if len(known) else one
            bucket, owner = gram_buckets(w, fresh)
            order = np.argsort(owner, kind="stable")
            grams.append(bucket[order].astype(np.int32))
            sizes.append(np.bincount(owner, minlength=len(fresh)))
            hashes.append(w.hash[fresh])
            known = np.sort(np.concatenate([known, w.hash[fresh]]))
            words.append(w.hash)
            counts.append(w.counts)
        every = np.concatenate(hashes)
        order = np.argsort(every)
        flat = np.concatenate([np.zeros(0, np.uint64), *words])
        self.words = order[np.searchsorted(every[order], flat)].astype(np.int32) if len(flat) else np.zeros(0, np.int32)
        self.first = np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))].astype(np.int64)
        self.grams = np.concatenate([np.zeros(0, np.int32), *grams])
        self.size = np.concatenate([np.zeros(0, np.int64), *sizes])
        self.at = np.cumsum(self.size) - self.size

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct words' n-gram buckets, how many each has, each word's distinct number, first word of each row)."""
        counts = (self.first[1:] - self.first[:-1])[rows]
        first = np.r_[0, np.cumsum(counts)]
        flat = np.repeat(self.first[rows] - first[:-1], counts) + np.arange(first[-1])
        one, local = np.unique(self.words[flat], return_inverse=True)
        n = self.size[one]
        at = np.repeat(self.at[one] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.grams[at], n, local, first


def fit(texts: list[str | None] | pa.Array, labels: np.ndarray, steps: int = 500, batch: int = 96, rate: float = 0.02, decay: float = 1e-6, seed: int = 7,
        run: int | None = RUN) -> Model:
    """Train on whole texts, a batch of them in numpy at a time. Without both classes every score is the share of label 1.

    A word's evidence is its mean vector times the softmax's difference of classes, so a step needs one number a bucket
    forwards, vectors @ odds, and one backwards, from which the gradients of vectors and softmax both follow.
    """
    labels = np.asarray(labels, float)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS, np.float32), -60.0 if share == 0 else 60.0, run)
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    typical = 1.0 if run is None else max((pc.sum(pc.utf8_length(column)).as_py() or 0) / len(column) / 6, 2.0)
    sample = Sample(column)

    rng = np.random.default_rng(seed)
    vectors = np.ascontiguousarray(rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32).T)  # a row a dimension
    softmax = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([0.0, -np.log(typical) + np.log(share / (1 - share))])
    parameters = (*vectors, softmax, bias)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    for _ in range(-(-steps // -(-len(column) // batch))):  # rounds over all texts, for about so many steps
        shuffled = rng.permutation(len(column))
        for lo in range(0, len(shuffled), batch):
            rows = shuffled[lo : lo + batch]
            grams, n, local, first = sample.take(rows)
            odds = softmax[:, 1] - softmax[:, 0]
            some = n > 0
            value = np.zeros(len(n))
            if len(grams):
                value[some] = np.add.reduceat((odds @ vectors)[grams].astype(float), (np.cumsum(n) - n)[some]) / n[some]
            z, begin, width, runs = run_means(value[local], first, run)
            pooled, part = log_sums(z, runs)
            error = (1 / (1 + np.exp(-np.clip(pooled + bias[1] - bias[0], -60, 60))) - labels[rows]) / len(rows)
            by_run = np.repeat(error, runs) * part / width
            change = np.bincount(begin, by_run, first[-1] + 1) - np.bincount(begin + width, by_run, first[-1] + 1)
            by_word = np.bincount(local, np.cumsum(change)[:-1], len(n))
            by_bucket = np.bincount(grams, np.repeat(by_word / np.maximum(n, 1), n), BUCKETS).astype(np.float32)
            toward = vectors @ by_bucket
            grads = (*(o * by_bucket + np.float32(decay) * v for o, v in zip(odds, vectors, strict=True)), np.stack([-toward, toward], 1), np.array([-error.sum(), error.sum()]))
            step += 1
            for p, g, (m, v) in zip(parameters, grads, state, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                g *= g
                g *= 0.001
                v += g
                np.sqrt(v, out=g)
                g /= np.sqrt(1 - 0.999**step)
                g += 1e-8
                np.divide(m, g, out=g)
                g *= rate / (1 - 0.9**step)
                p -= g
    return Model((softmax[:, 1] - softmax[:, 0]) @ vectors, float(bias[1] - bias[0]), run)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", held_out: int = 2, folds: int = 4, most: int = MOST_ROWS,
          id_col: str = "doc_id", text_col: str = "text", run: int | None = RUN) -> Model:
    """Fit on at most `most` labelled documents, of at most MOST_BYTES together, whose id's fold isn't held out.

    The bounded sample meets in one task, which fits; the driver gets one number for each n-gram bucket. An id with two labels
    has the larger; rows that repeat an id count each. run: words of a run, None for the average of whole texts.
    """

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = list(batches)
        if not given:
            return
        rows = pa.Table.from_batches(given).sort_by([("text", "ascending"), ("label", "ascending")])
        model = fit(pa.concat_arrays(rows["text"].chunks), rows["label"].to_numpy(), run=run)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.astype("<f4").tobytes()]), pa.array([model.bias])], ["weight", "bias"])

    rows = sample(docs, labels, label_col, fold("_id", folds) != held_out, most, id_col, text_col, MOST_BYTES)
    got = lean(rows).repartition(1).mapInArrow(fitted, "weight binary, bias double").first()
    return Model(np.frombuffer(got["weight"], "<f4"), got["bias"], run) if got else fit([], np.zeros(0), run=run)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text, however long; null and empty texts have no runs and score 0 (or the only class's score). Each
    row is scored by itself: repeated rows get equal scores, null ids stay, no rows give none. Only the two named columns are read."""
    shared = lean(docs).sparkSession.sparkContext.broadcast((model.weight, model.bias, model.run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets, 1 << 20):
                s = model.scores(Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(s)], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, whole and as they are, whose text scores under `least`; a tie with it goes. Rows with null or empty
    texts or without an id are judged like others, and columns of any name pass."""
    shared = lean(docs).sparkSession.sparkContext.broadcast((model.weight, model.bias, model.run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in batches:
            data, offsets = utf8(b.column(b.schema.get_field_index(text_col)))
            for lo, hi in chunks(offsets, 1 << 20):
                s = model.scores(Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1]))
                yield b.slice(lo, hi - lo).filter(pa.array(s < least))

    return docs.mapInArrow(run, docs.schema)
