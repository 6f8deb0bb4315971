"""Classifiers by held-out accuracy, the pipeline by plain versions of its stages, and the registered queries."""

import bisect
import inspect
import math
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartorio.llm import quality, queries, toxicity
from cartorio.llm.labelled import fold, sample
from cartorio.llm.text import BASE, Words, utf8
from tests.llm.test_small import SCHEMA, plain_contamination, plain_lines, plain_links, words_of

LARGE, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"


def held_out(spark, scored, label, n, k):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter(fold("doc_id", n) == k).select("score", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def test_quality_of_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    s, y = held_out(spark, quality.score(docs, quality.train(docs, labels)), "quality", 5, 0)
    assert ((s >= 0.3) == (y == 1)).mean() > 0.98 and (s[y == 1] >= 0.3).mean() > 0.99


def test_toxicity_of_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    s, y = held_out(spark, toxicity.score(docs, model), "toxic", 4, 2)
    assert (s[y == 1] >= 0.3).mean() > 0.85 and (s[y == 0] >= 0.3).mean() < 0.02
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def invented(seed, n):
    """n labelled texts of invented words; one in eight holds one or two of 90 invented insults, the rarest in about 0.1 % of them, a
    third of them with a letter changed, left out or doubled."""
    r = random.Random(seed)
    syllables = ["er", "an", "th", "in", "ed", "ou", "ble", "st", "re", "ha", "wh", "nd", "ti", "on", "sh", "en", "é", "ö", "ung", "ción"]
    word = lambda a, b: "".join(r.choice(syllables) for _ in range(r.randint(a, b)))
    common = [word(1, 4) for _ in range(4000)]
    insults = [word(2, 3) + r.choice(["zok", "grub", "vex", "klim", "purf", "dwaz"]) + r.choice(["", "er", "en", "y"]) for _ in range(90)]
    rows = []
    for i in range(n):
        words, toxic = r.choices(common, k=r.randint(20, 160)), int(r.random() < 1 / 8)
        for _ in range(r.randint(1, 2) if toxic else 0):
            bad = insults[min(int(r.paretovariate(0.5)) - 1, 89)] if r.random() < 0.5 else r.choice(insults)
            k = r.randrange(len(bad))
            bad = r.choice([bad, bad, bad, bad, bad[:k] + r.choice("aeiou") + bad[k + 1 :], bad[:k] + bad[k + 1 :], bad[:k] + bad[k] + bad[k:]])
            words.insert(r.randrange(len(words) + 1), bad)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_with_many_labels(spark):
    """The table above has 2,990 labels to fit on, 329 of them toxic, too few for its invented insults; here 12,000 are used."""
    assert toxicity.MOST_ROWS >= 12_000 and inspect.signature(toxicity.fit).parameters["steps"].default >= 500
    rows = spark.createDataFrame(invented(11, 17_000), "doc_id long, text string, toxic int").repartition(8)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "toxic")
    assert labels.filter(fold("doc_id", 4) != 2).count() >= 12_000
    out = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").filter(fold("doc_id", 4) == 2).select("score", "toxic").collect()
    s, y = (np.array([r[k] for r in out]) for k in (0, 1))
    assert (s[y == 1] >= 0.3).mean() > 0.95 and (s[y == 0] >= 0.3).mean() < 0.02


def test_an_unseen_misspelling_shares_its_ngrams():
    clean, bad = ["plain words of many kinds", "some other quiet talk here"] * 30, ["you worthless thing here", "what a worthless word"] * 30
    model = toxicity.fit(clean + bad, np.r_[np.zeros(60), np.ones(60)], steps=200)
    s = model.scores(Words(*utf8(pa.array(["you worthles thing here", "quiet plain talk", "", None]))))
    assert s[0] > 0.3 > s[1] and s[2] == s[3] < 0.3


@pytest.mark.parametrize("texts", [[], ["a"], ["a", "b"]])
def test_one_class_or_none(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in enumerate([*texts, None, ""])], SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        out = module.score(docs, module.train(docs, labels)).collect()
        assert len(out) == len(texts) + 2 and all(0 <= r["score"] <= 1 for r in out)


def test_labelled_null_texts_with_both_classes(spark):
    texts = [None, "plain words", "worthless thing", "", None, "more words", "worthless", "quiet talk"] * 4
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in enumerate(texts)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int("worthless" in (t or ""))) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(texts) and all(got[i] < 0.3 for i, t in enumerate(texts) if not t)
    assert toxicity.drop_toxic(docs, model).count() <= len(texts)


def test_the_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "é" * 500 if i == 3 else None if i == 4 else "ab" * 5) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    for most in (0, 10, 95, 1380, 1390):
        rows = sample(docs, labels, "toxic", F.lit(True), 100, most_bytes=most).collect()
        sizes = [len(r["text"].encode()) for r in rows]
        assert sum(sizes) <= most and set(sizes) <= {0, 10, 1000} and (len(rows) == 40) == (most >= 1380)


def plain_tree(g, h, leaves, ridge):
    """Greedy shallow tree on one feature's bins: every cut of every leaf is tried."""
    value = lambda lo, hi: sum(g[lo:hi]) ** 2 / (sum(h[lo:hi]) + ridge)
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(value(lo, k) + value(k, hi) - value(lo, hi), i, k) for i, (lo, hi) in enumerate(parts) for k in range(lo + 1, hi)]
        if not cuts or max(cuts)[0] <= 1e-9:
            break
        _, i, k = max(cuts)
        lo, hi = parts.pop(i)
        parts += [(lo, k), (k, hi)]
    out = [0.0] * len(g)
    for lo, hi in parts:
        for b in range(lo, hi):
            out[b] = -sum(g[lo:hi]) / (sum(h[lo:hi]) + ridge)
    return out


def test_a_boosting_round_and_the_look_ups_as_plain_versions():
    r = np.random.default_rng(1)
    x = r.random((200, len(quality.FEATURES)))
    y = (x[:, 0] + x[:, 3] * x[:, 5] + 0.3 * r.random(200) > 0.9).astype(int)
    model = quality.fit(x, y, rounds=1)
    z = [float(np.log(y.mean() / (1 - y.mean())))] * len(x)
    for f in range(x.shape[1]):
        edges = model.edges[f].tolist()
        bins = [bisect.bisect_left(edges, v) for v in x[:, f]]
        p = [1 / (1 + math.exp(-v)) for v in z]
        g, h = [0.0] * (len(edges) + 1), [0.0] * (len(edges) + 1)
        for b, q, label in zip(bins, p, y, strict=True):
            g[b] += q - label
            h[b] += max(q * (1 - q), 1e-6)
        table = [0.15 * v for v in plain_tree(g, h, 3, 1.0)]
        assert np.allclose(model.tables[f], table), f
        z = [v + table[b] for v, b in zip(z, bins, strict=True)]

    model = quality.fit(x, y, rounds=30)
    for row, got in zip(x, model.scores(x), strict=True):
        z = model.intercept + sum(t[bisect.bisect_left(e.tolist(), v)] for e, t, v in zip(model.edges, model.tables, row, strict=True))
        z += sum(t[bisect.bisect_left(e.tolist(), row[f])][bisect.bisect_left(k.tolist(), row[g])] for f, g, e, k, t in model.pairs)
        assert abs(got - 1 / (1 + math.exp(-z))) < 1e-9 and len(model.pairs) == quality.PAIRS


def plain_pair_tree(g, h, ridge):
    """(gain, table) by trying every cut of the first feature with every cut of the second on either side."""
    n, m = len(g), len(g[0])
    part = lambda t, a, b, c, d: sum(t[i][j] for i in range(a, b) for j in range(c, d))
    value = lambda a, b, c, d: part(g, a, b, c, d) ** 2 / (part(h, a, b, c, d) + ridge)
    best = (-1.0, None)
    for cut in range(1, n):
        sides = [max((value(a, b, 0, c) + value(a, b, c, m), -c) for c in range(1, m)) for a, b in ((0, cut), (cut, n))]
        gain = sides[0][0] + sides[1][0]
        if gain > best[0] + 1e-12:
            best = (gain, (cut, -sides[0][1], -sides[1][1]))
    cut, up, down = best[1]
    leaf = lambda *box: -part(g, *box) / (part(h, *box) + ridge)
    leaves = {(r, c): leaf(*((0, cut) if r else (cut, n)), *((0, up if r else down) if c else (up if r else down, m))) for r in (True, False) for c in (True, False)}
    return best[0] - part(g, 0, n, 0, m) ** 2 / (part(h, 0, n, 0, m) + ridge), [[leaves[i < cut, j < (up if i < cut else down)] for j in range(m)] for i in range(n)]


def test_pairs_as_a_plain_version():
    """The pairs that are chosen, and the one round of trees on them that three rounds of boosting have."""
    r = np.random.default_rng(3)
    x = r.random((150, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.4) ^ (r.random(150) < 0.1)).astype(int)
    model = quality.fit(x, y, rounds=3)
    z = [model.intercept + sum(t[bisect.bisect_left(e.tolist(), v)] for e, t, v in zip(model.edges, model.tables, row, strict=True)) for row in x]
    cuts = [quality._cuts(x[:, f], quality.PAIR_BINS).tolist() for f in range(x.shape[1])]
    bins = [[bisect.bisect_left(c, v) for v in x[:, f]] for f, c in enumerate(cuts)]

    def sums(f, k):
        g, h = ([[0.0] * (len(cuts[k]) + 1) for _ in range(len(cuts[f]) + 1)] for _ in range(2))
        for a, b, v, label in zip(bins[f], bins[k], z, y, strict=True):
            p = 1 / (1 + math.exp(-v))
            g[a][b] += p - label
            h[a][b] += max(p * (1 - p), 1e-6)
        return g, h

    gains = {(f, k): plain_pair_tree(*sums(f, k), 1.0)[0] for f in range(x.shape[1]) for k in range(f + 1, x.shape[1])}
    chosen = sorted(gains, key=lambda p: -gains[p])[: quality.PAIRS]
    assert [p[:2] for p in model.pairs] == chosen and (2, 7) in chosen[:2]
    for f, k, _, _, table in model.pairs:
        want = [[0.15 * v for v in row] for row in plain_pair_tree(*sums(f, k), 1.0)[1]]
        assert np.allclose(table, want), (f, k)
        z = [v + want[a][b] for v, a, b in zip(z, bins[f], bins[k], strict=True)]


def test_a_step_of_the_toxicity_fit_follows_its_gradient():
    """One step over all texts against numerical derivatives of the loss, for the softmax, the bias and vectors of n-grams. Adam's first
    step is the rate in the direction of each derivative's sign."""
    texts, labels = ["vex ab", "cd vexx ef", "ab cd", "ef gh ab", "", "gh"], np.array([1, 1, 0, 0, 0, 0.0])
    model = toxicity.fit(texts, labels, steps=1, batch=6)
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.1, (toxicity.BUCKETS, toxicity.DIMENSIONS)).astype(np.float32).astype(float)
    softmax = rng.normal(0, 0.3, (toxicity.DIMENSIONS, 2)).astype(np.float32).astype(float)
    typical, share = max(sum(map(len, texts)) / len(texts) / 6, 2.0), labels.mean()
    bias = -math.log(typical) + math.log(share / (1 - share))
    words = Words(*utf8(pa.array(texts)))
    bucket, owner = toxicity.gram_buckets(words, np.arange(len(words.start)))

    def loss(vectors, softmax, bias):
        odds = softmax[:, 1] - softmax[:, 0]
        value = [float(np.mean([vectors[b] @ odds for b in bucket[owner == w]])) for w in range(len(words.start))]
        total = 0.0
        for r, label in enumerate(labels):
            own = value[words.first[r] : words.first[r + 1]]
            runs = [np.mean(own[i : i + toxicity.RUN]) for i in range(max(len(own) - toxicity.RUN + 1, 1))] if own else []
            p = 1 / (1 + math.exp(-max(min((math.log(sum(map(math.exp, runs))) if runs else -60) + bias, 60), -60)))
            total -= (label * math.log(max(p, 1e-300)) + (1 - label) * math.log(max(1 - p, 1e-300))) / len(labels)
        return total

    def slope(change):
        up, down = (loss(*change(e)) for e in (1e-4, -1e-4))
        return (up - down) / 2e-4

    after = {}  # the fit's own parameters aren't given out: what it moved is told by the weights it returns
    d_soft = np.array([[slope(lambda e, i=i, j=j: (vectors, softmax + e * (np.arange(8)[:, None] == i) * (np.arange(2) == j), bias)) for j in range(2)] for i in range(toxicity.DIMENSIONS)])
    moved = softmax - 0.02 * np.sign(d_soft)
    odds, before = moved[:, 1] - moved[:, 0], softmax[:, 1] - softmax[:, 0]
    for b in np.unique(bucket)[:12]:
        d = slope(lambda e, b=b: (np.where(np.arange(len(vectors))[:, None] == b, vectors + e * before / (before @ before), vectors), softmax, bias))
        after[b] = (vectors[b] - 0.02 * np.sign(d * before)) @ odds
    assert len(after) == 12 and all(abs(model.weight[b] - v) < 2e-3 for b, v in after.items())
    d_bias = slope(lambda e: (vectors, softmax, bias + e))
    assert abs(model.bias - (bias - 2 * 0.02 * np.sign(d_bias))) < 1e-3


@pytest.mark.parametrize("run", [None, 1, 2])
def test_toxicity_scores_as_a_plain_version(run):
    """Mean of a word's n-gram weights, means over runs of words, and the log of the sum of exp over runs."""
    weight = np.random.default_rng(2).normal(0, 2, toxicity.BUCKETS).astype(np.float32)
    texts = ["One, two THREE four", "é", "a b", "", "word", "worthless   thing\nindeed and more of it 12"]

    def mixed(x):
        for _ in range(2):
            x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 % 2**64
        return x ^ (x >> 32)

    def word_value(w):
        raw, out = b"<" + w + b">", []
        for n in toxicity.GRAMS:
            for k in range(len(raw) - n + 1):
                h = 0
                for c in raw[k : k + n]:
                    h = (h * int(BASE) + c) % 2**64
                out.append(float(weight[mixed((h + n) % 2**64) % toxicity.BUCKETS]))
        return sum(out) / max(len(out), 1)

    got = toxicity.Model(weight, -0.7, run).scores(Words(*utf8(pa.array(texts))))
    for text, score in zip(texts, got, strict=True):
        values = [word_value(w) for w in words_of(text)]
        n = min(run or len(values), len(values))
        runs = [sum(values[k : k + n]) / n for k in range(len(values) - n + 1)] if values else []
        want = 1 / (1 + math.exp(0.7 - math.log(sum(map(math.exp, runs))))) if runs else 0.0
        assert abs(score - want) < 1e-5


def test_repeated_ids_conflicting_labels_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a worthless thing"), (1, "a worthless thing"), (2, "quiet talk"), (3, "plain words"), (None, "x"), (4, None)], "doc_id long, text string")
    docs = docs.withColumns({n: F.lit("clash") for n in ("id", "score", "label", "_id", "toxic", "quality", "weight", "fold")})
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (2, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    rows = sorted((r["text"], r["label"]) for r in sample(docs, labels, "toxic", F.lit(True), 10).collect())
    assert rows == [("a worthless thing", 1)] * 2 + [("plain words", 0), ("quiet talk", 0)]
    for module in (quality, toxicity):
        out = module.score(docs, module.train(docs, labels)).collect()
        assert len(out) == 6 and len({r["score"] for r in out if r["doc_id"] == 1}) == 1 and all(0 <= r["score"] <= 1 for r in out)
    kept = toxicity.drop_toxic(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    rows = docs.orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]

    lines = stage["line dedup"](spark, docs, SMALL)
    assert lines.columns == docs.columns
    got = {r["doc_id"]: r for r in lines.collect()}
    assert [got[r["doc_id"]]["text"] for r in rows] == plain_lines(texts)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    links = plain_links(texts)
    kept = {r["doc_id"] for r in stage["n-gram Jaccard join"](spark, docs, SMALL).collect()}
    assert kept == {r["doc_id"] for i, r in enumerate(rows) if links[i][0] == i}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = plain_contamination(texts, items)
    kept = {r["doc_id"] for r in stage["benchmark decontamination"](spark, docs, SMALL).collect()}
    assert kept == {r["doc_id"] for i, r in enumerate(rows) if not bad[i][3]}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (None, "a b c", None, "s", 5), (1, "", "en", None, 0), (2, "w " * 30_000, None, "s", 60_000),
                                       (3, "x y z", None, "s", 5), (3, "x y z", None, "s", 5)]])
def test_stages_on_nulls_empty_long_and_repeated_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("class_id", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() == len(rows), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.groupBy().agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0] == sum(len((r[1] or "").split()) for r in rows)


def test_pipeline_runs_all_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 0 < out.select("doc_id").distinct().count() <= docs.count()
    assert out.groupBy("bin_id").agg(F.sum("n_words").alias("n")).filter("bin_id is not null and n > 2048").count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    rows = queries.QUERIES[name](spark, SMALL).collect()
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for f in os.listdir(SMALL):
            con.sql(f"create view {f.split('.')[0]} as select * from '{SMALL}/{f}'")
        want = con.sql(queries.ORACLE_SQL[name])
        assert sorted(tuple(str(r[c]) for c in want.columns) for r in rows) == sorted(tuple(map(str, r)) for r in want.fetchall())
    if name == "op13_spelling":  # a row a word
        assert len({r["word"] for r in rows}) == len(rows) > 1000
    else:
        assert len({r["doc_id"] for r in rows}) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
