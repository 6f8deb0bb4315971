"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is a set of placed shingles (three consecutive words each, fewer in shorter windows). To hold a window whole, a
document must hold all its shingles, so one of them is prefix enough: shingles are ordered by how many documents hold them,
and each different window joins on its rarest. The scan of the documents looks for prefix shingles only and passes them
on with the words around them; each place there at which a window with that prefix would begin must fit the document's length,
and the words there are compared with the windows' whole. Items come in last, by the windows found, so that a window
of very many items is looked for once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.llm.frames import lean, reliable
from cartorio.llm.text import Words, chunks, utf8

SHINGLE = 3
#: Bits of the map by which tasks know the shingles they look for: two are set for each, SPARSE of them there are for each (one look in
#: 60 is for nothing then), LEAST_BITS at least, and MOST_BITS at most (128 MB); of more shingles some are looked for in
#: further scans.
SPARSE, LEAST_BITS, MOST_BITS = 16, 1 << 26, 1 << 30
#: Rows that are broadcast at most; beyond it Spark joins by shuffles.
FEW = 50_000


def _rows(words: Words) -> Iterator[list[bytes]]:
    raw = words.data.tobytes()
    for lo, hi in pairwise(words.first):
        yield [raw[s:e] for s, e in zip(words.start[lo:hi], words.end[lo:hi], strict=True)]


def windows(benchmark: DataFrame, size: int = 13, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, window): the different windows of each item, as their words joined by blanks. An item of fewer than
    `size` words, but not none, is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets, 1 << 18):
                at, out = [], []
                for k, words in enumerate(_rows(Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1]))):
                    n = min(size, len(words))
                    own = list({b" ".join(words[i : i + n]).decode(errors="replace") for i in range(len(words) - n + 1)}) if n else []
                    at += [lo + k] * len(own)
                    out += own
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(out, pa.string())], ["item", "window"])

    return benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "item string, window string")


def placed_shingles(distinct: DataFrame) -> DataFrame:
    """(window, size, at, shingle): the hashed shingles of each window by their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(*utf8(b.column(0)))
            counts = words.counts
            found = []
            for q in range(1, SHINGLE + 1):
                value, place = words.shingles(q)
                doc = words.doc[place]
                own = np.minimum(counts[doc], SHINGLE) == q
                found.append((value[own], place[own], doc[own]))
            value, place, doc = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(counts[doc].astype(np.int32)), pa.array((place - words.first[doc]).astype(np.int32)),
                                              pa.array(value.view(np.int64))], ["window", "size", "at", "shingle"])

    return distinct.mapInArrow(run, "window string, size int, at int, shingle long")


class Map:
    """A bitmap of hashes, gathered by Spark; the driver gets its non-zero words, at most bits / 64 of them."""

    def __init__(self, hashes: DataFrame, bits: int):
        place = F.explode(F.array(*(F.shiftrightunsigned("shingle", by).bitwiseAND(bits - 1) for by in (0, 32)))).alias("p")
        words = hashes.select(place).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
        self.words = np.zeros(bits // 64, np.uint64)
        self.words[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be among those of the map."""
        left = np.arange(len(h))
        for by in (0, 32):
            p = (h[left] >> np.uint64(by)) & np.uint64(64 * len(self.words) - 1)
            left = left[(self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return left


def maps(hashes: DataFrame) -> list[Map]:
    """Sparse maps that hold all the different shingles together, each a share of them: one up to MOST_BITS / SPARSE shingles."""
    n = hashes.count()
    passes = max(1, -(-n * SPARSE // MOST_BITS))
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (-(-n // passes) * SPARSE - 1).bit_length()))
    if passes == 1:
        return [Map(hashes, bits)]
    return [Map(hashes.filter(F.pmod(F.xxhash64("shingle"), F.lit(passes)) == k), bits) for k in range(passes)]


def _found(words: Words, known: Map, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of each shingle of the words that the map has."""
    values, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for q in sizes:
        value, place = words.shingles(q)
        at = known.has(value)
        values.append(value[at])
        places.append(place[at])
    return np.concatenate(values), np.concatenate(places)


def frequencies(texts: DataFrame, known: Map, sizes: tuple[int, ...]) -> DataFrame:
    """(shingle, documents): how many texts hold each shingle of the map."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(0))
            for lo, hi in chunks(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                value, place = _found(words, shared.value, sizes)
                doc = words.doc[place]
                order = np.lexsort((doc, value))
                value, doc = value[order], doc[order]
                once = np.r_[True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])][: len(value)]
                one, n = np.unique(value[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(n)], ["shingle", "n"])

    return texts.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("documents"))


def prefix_hits(texts: DataFrame, known: Map, sizes: tuple[int, ...], size: int) -> DataFrame:
    """(id, n_words, hits) of every text; a hit is a shingle of the map, its place, and the words around it from `begin` on."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                value, place = _found(words, shared.value, sizes)
                order = np.argsort(place, kind="stable")
                value, place = value[order], place[order]
                doc = words.doc[place]
                first, last = words.first[doc], words.first[doc + 1]
                begin, end = np.maximum(first, place - size + 1), np.minimum(last, place + size)
                raw = words.data.tobytes()
                s, e = words.start, words.end
                around = [b" ".join([raw[s[k] : e[k]] for k in range(x, y)]).decode(errors="replace") for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
                hits = pa.StructArray.from_arrays([pa.array(value.view(np.int64)), pa.array((place - first).astype(np.int32)), pa.array((begin - first).astype(np.int32)),
                                                   pa.array(around, pa.string())], ["shingle", "place", "begin", "around"])
                bounds = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), hits)],
                                                 ["id", "n_words", "hits"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, n_words long, hits array<struct<shingle:long,place:int,begin:int,around:string>>")


def _light(df: DataFrame) -> DataFrame:
    """df, to be broadcast if a count shows few rows."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, spans, items, contaminated) of every document, in any order.

    n_hit counts the words inside any occurrence of a window, and spans (start and end, in words) are where they stand;
    items are the ids, as sorted strings, whose windows occur; contaminated means n_hit > 0 and share * n_hit >= n_words.
    Null and empty texts and items have no words; items with a null id count as hits but aren't listed. An empty benchmark
    contaminates nothing, and no documents give no rows. Texts and items of any length are taken whole. Equal items are both
    listed. Ids are unique; rows that repeat one in full get equal results, and rows with a null id count as clean. Only the
    named columns are read, so others may have any name. A benchmark of over MOST_BITS / SPARSE different shingles (67 million)
    takes two more scans for each further such number; results are the same.
    """
    texts = lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    owners = reliable(windows(benchmark, size, item_col, item_text_col))
    placed = reliable(placed_shingles(owners.select("window").distinct()))
    sizes = tuple(sorted(r[0] for r in placed.select(F.least("size", F.lit(SHINGLE))).distinct().collect()))
    frequency = reduce(DataFrame.unionByName, [frequencies(texts, known, sizes) for known in maps(placed.select("shingle").distinct())])
    frequency = frequency.groupBy("shingle").agg(F.max("documents").alias("documents"))  # a map may have one of another's by chance
    # A window with a shingle that no document holds can't occur; the others' prefix is their rarest shingle.
    prefixes = reliable(placed.join(frequency, "shingle", "left").groupBy("window", "size")
                        .agg(F.min(F.struct(F.coalesce("documents", F.lit(0)).alias("documents"), "shingle", "at")).alias("least"))
                        .filter("least.documents > 0").select("window", "size", "least.shingle", "least.at"))
    held, *more = [reliable(prefix_hits(texts, known, sizes, size)) for known in maps(prefixes.select("shingle").distinct())]
    hits = reduce(DataFrame.unionByName, more, held)
    shapes = prefixes.select("shingle", "at", "size").distinct()
    # Spark may cut the words before it filters by start, so a start before the text is moved to its begin there.
    found = (hits.filter("id is not null").select("id", "n_words", F.explode("hits").alias("hit")).select("id", "n_words", "hit.*").join(_light(shapes), "shingle")
             .withColumn("start", F.col("place") - F.col("at")).filter("start >= 0 and start + size <= n_words")
             .withColumn("window", F.array_join(F.slice(F.split("around", " "), F.greatest(F.col("start") - F.col("begin") + 1, F.lit(1)), F.col("size")), " "))
             .join(_light(prefixes.select("window")), "window").select("id", "start", (F.col("start") + F.col("size")).alias("end"), "window").distinct())
    found = reliable(found)

    by_start = Window.partitionBy("id").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    merged = (found.select("id", "start", "end").distinct().withColumn("fresh", (F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int"))
              .withColumn("span", F.sum("fresh").over(by_start)).groupBy("id", "span").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    spans = merged.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"))
    items = (found.select("id", "window").distinct().join(owners, "window").select("id", "item").distinct()
             .groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("items")))
    out = held.select("id", "n_words").join(spans, "id", "left").join(items, "id", "left")
    out = out.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                     F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return (out.withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words"))
            .select(F.col("id").alias(id_col), "n_words", "n_hit", "spans", "items", "contaminated"))
