"""N-gram Jaccard join: all pairs of texts whose sets of word shingles are similar, as classes and link counts.

Equal word sequences fold to one representative first. Representatives that share a band of MinHash values are
candidates, each pair in the first band that it shares, so that no pair is looked at twice. Their values are compared in
steps; a pair goes as soon as the posterior probability of reaching the threshold (uniform prior, binomial matches) falls
below a tolerance. Representatives with a pair left get their shingle sets sent to that band's bucket, and the pairs left
are verified exactly there. Buckets of any size are dealt in pairs of blocks, so no task holds more than two blocks, no pair
becomes a row, and every representative's links are counted once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.components import components
from cartorio.llm.frames import lean, reliable
from cartorio.llm.text import BASE, Words, chunks, mix, utf8

#: 32 bands of 5 values: a pair at similarity 0.8 shares none of them once in 300,000 pairs.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEPS = (16, 32, 64, 96, 128, HASHES)
TOLERANCE = 1e-5
#: Blocks of a bucket: signatures, and shingle sets (rows and words); pairs compared at once; children in a class's tree.
BUCKET_BLOCK, GROUP_BLOCK, GROUP_WORDS, AT_ONCE, CHILDREN = 4096, 512, 500_000, 200_000, 8

_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


@cache
def least_matches(threshold: Fraction) -> tuple[int, ...]:
    """For each step, the fewest equal values with which a pair stays: with a uniform prior the posterior chance of
    a similarity over t after m of n matches is the chance of at most m in n + 1 draws at t."""
    t, out = float(threshold), []
    for n in STEPS:
        below = np.cumsum([comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m) for m in range(n + 1)])
        out.append(int(np.searchsorted(below, TOLERANCE)))
    return tuple(out)


class Rows:
    """Rows of some buckets (group) of one band each (at), with the bands and signature of their representatives."""

    def __init__(self, table: pa.Table):
        self.order = np.argsort(table.column("band").to_numpy(), kind="stable")
        self.group = table.column("band").to_numpy()[self.order]
        self.at = table.column("at").to_numpy()[self.order]
        self.block = table.column("block").to_numpy()[self.order]
        self.cross = bool(len(table)) and table.column("i")[0] != table.column("j")[0]
        column = lambda name, kind, n: np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(-1, n)[self.order]
        self.bands, self.signature = column("bands", np.int64, BANDS), column("signature", np.uint8, HASHES)

    def pairs(self, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Wanted pairs (a < b, in one group) whose first common band is the group's and whose signatures still may reach the
        threshold, compared step by step. In a pair of blocks, those across."""
        n = len(self.group)
        if not n:
            return
        last = np.r_[np.flatnonzero(self.group[1:] != self.group[:-1]), n - 1]
        later = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n)
        total, lo = np.cumsum(later), 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + AT_ONCE, "right")))
            c = later[lo:hi]
            a = np.repeat(np.arange(lo, hi), c)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
            lo = hi
            keep = wanted(a, b)
            if self.cross:
                keep &= self.block[a] != self.block[b]
            a, b = a[keep], b[keep]
            for k in range(BANDS):  # out where an earlier band is common
                if not (self.at[a] > k).any():
                    break
                keep = (self.at[a] <= k) | (self.bands[a, k] != self.bands[b, k])
                a, b = a[keep], b[keep]
            matches, done = np.zeros(len(a), np.int32), 0
            for step, least in zip(STEPS, least_matches(threshold), strict=True):
                matches += (self.signature[a, done:step] == self.signature[b, done:step]).sum(1, dtype=np.int32)
                keep = matches >= least
                a, b, matches, done = a[keep], b[keep], matches[keep], step
            yield a, b


def marks(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text_key, n_words, packed_bands, bands, signature); texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets, 1 << 19):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                rows = np.flatnonzero(words.counts > 0)
                if not len(rows):
                    continue
                value, place = words.shingles(size, short=True)
                doc = words.doc[place]
                order = np.argsort(doc, kind="stable")
                value, doc = value[order], doc[order]
                first = np.searchsorted(doc, rows)
                least = np.stack([np.minimum.reduceat(value * a, first) for a in _FACTORS], 1)
                banded = mix(least).reshape(len(rows), BANDS, ROWS)
                bands = np.zeros((len(rows), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = bands * BASE + banded[:, :, r]
                bands = mix(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                signature = (mix(least) >> np.uint64(40)).astype(np.uint8)
                # The word sequence: two sums of placed hashes, 128 bits.
                inner = np.arange(len(words.hash), dtype=np.uint64) - words.first[words.doc].astype(np.uint64)
                at = words.first[rows]
                keys = [np.add.reduceat(mix(words.hash + mix(inner + np.uint64(s))), at) for s in (1, 1 << 40)]
                key = np.stack(keys, 1).tobytes()
                text = np.array([hash_bytes(words, offsets, data, lo, r) for r in rows], np.int64)
                ids = b.column(0).slice(lo, hi - lo).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([key[i : i + 16] for i in range(0, len(key), 16)], pa.binary()), pa.array(text), pa.array(words.counts[rows].astype(np.int64)),
                    pa.array([x.tobytes() for x in bands], pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel())),
                    pa.array([s.tobytes() for s in signature], pa.binary())], ["id", "key", "text_key", "n_words", "packed_bands", "bands", "signature"])

    def hash_bytes(words: Words, offsets: np.ndarray, data: np.ndarray, lo: int, row: int) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(data[offsets[lo + row] : offsets[lo + row + 1]].tobytes()) - (1 << 63)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, key binary, text_key long, n_words long, packed_bands binary, bands array<long>, signature binary")


def dealt(df: DataFrame, rows: F.Column, packs: int) -> DataFrame:
    """df (band, rep) with (pack, i, j): a bucket of one block goes whole into a pack; of a larger one each row goes, with
    its block, to every pair of blocks that has it. `rows` is the number of blocks."""
    df = df.withColumn("blocks", rows).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(17)), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    small = F.col("blocks") == 1
    return (df.withColumn("pack", F.when(small, F.pmod(F.xxhash64("band"), F.lit(packs))).otherwise(F.xxhash64("band", F.lit(5))))
            .withColumn("i", F.when(small, -1).otherwise(F.least("block", "other"))).withColumn("j", F.when(small, -1).otherwise(F.greatest("block", "other")))
            .drop("other", "blocks"))


def with_pairs(hits: DataFrame, kind: str, threshold: Fraction) -> DataFrame:
    """(band, at, rep) of each row of a bucket that a pair left there has."""

    def run(table: pa.Table) -> pa.Table:
        rows = Rows(table)
        live = np.zeros(len(rows.group), bool)
        for a, b in rows.pairs(lambda a, b: ~(live[a] & live[b]), threshold):
            live[a] = live[b] = True
        return table.select(["band", "at", "rep"]).take(pa.array(rows.order[live]))

    return hits.groupBy("pack", "i", "j").applyInArrow(run, f"band long, at int, rep {kind}")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays. Rare values add pair by pair, common ones by
    matrix products over blocks of columns."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    value = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    start = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, int)
    times = np.diff(np.r_[start, len(value)])
    out = np.zeros(n * n)
    few = 16
    for t in range(2, few + 1):
        at = start[times == t]
        for x in range(t):
            for y in range(x + 1, t):
                p, q = row[at + x], row[at + y]
                out += np.bincount(np.minimum(p, q) * n + np.maximum(p, q), minlength=n * n) if len(at) * 8 > n * n else 0
                if len(at) * 8 <= n * n:
                    np.add.at(out, np.minimum(p, q) * n + np.maximum(p, q), 1)
    out = out.reshape(n, n)
    out += out.T
    often = np.flatnonzero(times > few)
    for lo in range(0, len(often), 2048):
        some = often[lo : lo + 2048]
        where = np.repeat(start[some] - np.r_[0, np.cumsum(times[some])[:-1]], times[some]) + np.arange(times[some].sum())
        block = np.zeros((n, len(some)), np.float32)
        block[row[where], np.repeat(np.arange(len(some)), times[some])] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
    return intersections(sets)[a, b]


def _tree(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows a row that the links (a, b) connect it to, the least itself: a tree with few children a row for each
    class, so that no row gets many edges."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new[label]]
        if (new == label).all():
            break
        label = new
    order = np.argsort(label, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0])[: n]
    start = np.repeat(first, np.diff(np.r_[first, n])) if n else order
    up = np.empty(n, np.int64)
    up[order] = order[start + np.maximum(np.arange(n) - start - 1, 0) // CHILDREN]
    return up


def verified(members: DataFrame, kind: str, threshold: Fraction) -> DataFrame:
    """(rep, links, up): a representative's verified links in a bucket or a pair of its blocks, each weighed by the texts
    of the other side, and another representative that verified links connect it to there."""
    top, down = threshold.numerator, threshold.denominator

    def run(table: pa.Table) -> pa.Table:
        # Rows that repeat an id count once.
        band, code = table.column("band").to_numpy(), table.column("rep").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((code, band))
        fresh = np.r_[True, (np.diff(band[order]) != 0) | (np.diff(code[order]) != 0)] if len(order) else order
        table = table.take(pa.array(order[fresh.astype(bool)]))
        rows = Rows(table)
        reps = table.column("rep").take(pa.array(rows.order))
        texts, shingles = table.column("n_texts").to_numpy()[rows.order], table.column("shingles").take(pa.array(rows.order))
        left = [np.stack(p) for p in rows.pairs(lambda a, b: np.ones(len(a), bool), threshold)]
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *left], axis=1)
        linked = np.zeros(len(a), bool)
        # Pairs come in the order of their groups; the sets of a group at a time are compared.
        for some in np.split(np.arange(len(a)), np.flatnonzero(np.diff(rows.group[a])) + 1) if len(a) else ():
            who, local = np.unique(np.r_[a[some], b[some]], return_inverse=True)
            sets = [np.frombuffer(shingles[int(x)].as_py(), np.uint64) for x in who]
            size = np.array([len(s) for s in sets])
            x, y = local[: len(some)], local[len(some) :]
            linked[some] = _shared(sets, x, y) * (down + top) >= top * (size[x] + size[y])
        a, b = a[linked], b[linked]
        n = len(rows.group)
        links = np.bincount(a, texts[b], n) + np.bincount(b, texts[a], n)
        up = _tree(n, a, b)
        own = np.flatnonzero(links > 0)
        return pa.table({"rep": reps.take(pa.array(own)), "links": pa.array(links[own].astype(np.int64)), "up": reps.take(pa.array(up[own]))})

    return members.groupBy("pack", "i", "j").applyInArrow(run, f"rep {kind}, links long, up {kind}")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """docs (rep, text, ...) with the text replaced by its sorted distinct shingle hashes."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(b.schema.get_field_index("text")))
            for lo, hi in chunks(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                value, place = words.shingles(size, short=True)
                doc = words.doc[place]
                order = np.lexsort((value, doc))
                value, doc = value[order], doc[order]
                fresh = np.r_[True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])] if len(value) else np.zeros(0, bool)
                value, doc = value[fresh], doc[fresh]
                bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
                sets = pa.array([value[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in keep), sets], [*keep, "shingles"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.mapInArrow(run, f"{schema}, shingles binary")


def join(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links) of every document.

    Words are runs of letters and digits, A-Z lower-cased; a shingle is `size` of them, or all words of a shorter
    text. Two texts are linked when the Jaccard similarity of their shingle sets is at least the threshold. class_id
    is the least id that links and equal word sequences connect; n_links counts the different texts linked to the
    document's (equal texts count once, and not for each other). Texts without words, null ones too, are alone in
    their class. Ids are unique; rows that repeat one in full get equal results, and a null id has a null class.
    """
    threshold = Fraction(str(threshold))
    kind = docs.schema[id_col].dataType.simpleString()
    marked = reliable(marks(lean(docs), size, id_col, text_col))
    firsts = [F.first(c).alias(c) for c in ("n_words", "packed_bands", "bands", "signature")]
    by_text = marked.groupBy("key", "text_key").agg(F.min("id").alias("rep"), *firsts)
    reps = reliable(by_text.groupBy("key").agg(F.min("rep").alias("rep"), F.count("*").alias("n_texts"), *firsts).filter("rep is not null"))
    packs = max(1, ceil(reps.count() / 1000))

    bands = reps.select("rep", F.posexplode("bands").alias("at", "band"))
    # Sizes of buckets are written, so that their joins are plain ones, of which Spark splits the long keys.
    full = reliable(bands.groupBy("at", "band").agg(F.count("*").alias("m")).filter("m > 1"))
    hits = bands.join(full, ["at", "band"]).join(reps.select("rep", F.col("packed_bands").alias("bands"), "signature"), "rep")
    live = reliable(with_pairs(dealt(hits, F.ceil(F.col("m") / BUCKET_BLOCK), packs), kind, threshold).distinct())

    words = reps.select("rep", "n_words", "n_texts", F.col("packed_bands").alias("bands"), "signature").join(live.select("rep").distinct(), "rep")
    sized = reliable(live.join(reps.select("rep", "n_words"), "rep").groupBy("at", "band").agg(F.count("*").alias("m"), F.sum("n_words").alias("w")))
    blocks = F.greatest(F.ceil(F.col("m") / GROUP_BLOCK), F.ceil(F.col("w") / GROUP_WORDS))
    packs = max(1, ceil((sized.agg(F.sum("w")).first()[0] or 0) / GROUP_WORDS))
    text = docs.select(F.col(id_col).alias("rep"), F.col(text_col).cast("string").alias("text"))
    sets = shingle_sets(text.join(words.drop("n_words"), "rep"), size)
    members = live.join(sized.select("at", "band", blocks.alias("nb")), ["at", "band"]).join(sets, "rep")
    found = reliable(verified(dealt(members, F.col("nb"), packs).drop("nb"), kind, threshold))
    classes = components(found.select(F.col("rep").alias("a"), F.col("up").alias("b")))

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    judged = (reps.select("key", "rep", "n_texts").join(links, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("n_texts") - 1).alias("n_links")))
    with_words = marked.select("id", "key").join(judged, "key").groupBy("id").agg(F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))
    ids = docs.select(F.col(id_col).alias("id"))
    return (ids.join(with_words, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
            .withColumnRenamed("id", id_col))
