"""Best-fit packing with conflicts: each piece of text goes to the tightest bin that has room and no conflict.

Bins are ordered by what room they have left. Each carries a bitmap of its sources (a few places a source) and of
its duplicate clusters (one place each). A tree over the rooms holds the bits that all bins below share, so the
search for the next larger room passes whole ranges of bins that conflict, until the tightest compatible one.
"""

from __future__ import annotations

import hashlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean, reliable
from cartorio.llm.text import utf8


class Bins:
    """Open bins of one shard. `place` returns the number of the bin that takes a piece."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves = capacity, 1 << capacity.bit_length()
        self.shared = [-1] * (2 * self.leaves)  # -1: no bin below
        self.by_room: dict[int, list[int]] = {}
        self.room: list[int] = []
        self.bits: list[int] = []

    def _refresh(self, room: int) -> None:
        at, value = room + self.leaves, -1
        for b in self.by_room.get(room, ()):
            value &= self.bits[b]
        while at and self.shared[at] != value:
            self.shared[at] = value
            at >>= 1
            value = self.shared[2 * at] & self.shared[2 * at + 1] if at else value

    def _tightest(self, node: int, lo: int, hi: int, size: int, source: int, cluster: int) -> int | None:
        """First compatible bin below the node, by room and then by number; bits: a full source, or the cluster."""
        shared = self.shared[node]
        if hi < size or shared & source == source or shared & cluster:
            return None
        if lo == hi:
            return next((b for b in self.by_room.get(lo, ()) if self.bits[b] & source != source and not self.bits[b] & cluster), None)
        mid = (lo + hi) // 2
        found = self._tightest(2 * node, lo, mid, size, source, cluster)
        return found if found is not None else self._tightest(2 * node + 1, mid + 1, hi, size, source, cluster)

    def place(self, size: int, source: int, cluster: int) -> int:
        """source: all places of the piece's source; cluster: the cluster's bit, 0 where it has one member."""
        b = self._tightest(1, 0, self.leaves - 1, size, source, cluster)
        if b is None:
            b = len(self.room)
            self.room.append(self.capacity)
            self.bits.append(0)
        else:
            here = self.by_room[self.room[b]]
            here.remove(b)
            self._refresh(self.room[b])
        free = source & ~self.bits[b]
        self.bits[b] |= (free & -free) | cluster
        self.room[b] -= size
        insort(self.by_room.setdefault(self.room[b], []), b)
        self._refresh(self.room[b])
        return b


def pack_shard(pieces: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Best fit in decreasing size; ties by id as text and piece."""
    pieces = pieces.sort_values(["n_words", "id", "piece"], ascending=[False, True, True], kind="stable")
    sources = {s: ((1 << per_source) - 1) << (i * per_source) for i, s in enumerate(pieces["source"].drop_duplicates())}
    several = [c for c, n in Counter(pieces["cluster"]).items() if n > 1]
    clusters = {c: 1 << (len(sources) * per_source + i) for i, c in enumerate(sorted(several))}
    bins = Bins(capacity)
    pieces["bin"] = [bins.place(n, sources[s], clusters.get(c, 0)) for n, s, c in zip(pieces["n_words"], pieces["source"], pieces["cluster"], strict=True)]
    return pieces


def pack(docs: DataFrame, capacity: int = 2048, per_source: int = 4, shard_pieces: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """(id, piece, first_word, n_words, bin_id, bin_words): where each piece of every text goes.

    Sizes are words between ASCII white space. A text longer than the capacity is cut into pieces of it and a rest, whatever its
    length. No bin holds two pieces of one duplicate cluster (by default texts that are equal but for A-Z's case and white space),
    or over `per_source` pieces of one source. Null and empty texts have one row of no words and no bin; no documents give no rows. A
    null source is a source of its own; a null id is an id like others. Rows that repeat another in full are packed each. Pieces
    of equal size are taken by id as text and then by piece. Shards of about `shard_pieces` pieces, dealt by a hash of id, piece and cluster
    (rows without an id: of their place), are packed independently, so no source or cluster meets in one task, and each shard
    leaves less than a bin more of waste. Only the named columns are read, so others may have any name.
    """
    given = lean(docs).select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                        F.col(text_col).cast("string").alias("text"), (F.col(cluster_col).cast("string") if cluster_col else F.lit(None).cast("string")).alias("cluster"))
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(2))
            words, clusters = [], []
            for lo, hi in pairwise(offsets.tolist()):
                split = data[lo:hi].tobytes().lower().split()
                words.append(len(split))
                clusters.append(hashlib.blake2b(b" ".join(split), digest_size=16).hexdigest())
            own = b.column(3) if cluster_col else pa.array(clusters)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), own, pa.array(words, pa.int64())], ["id", "source", "cluster", "words"])

    # Sizes are written once: shards are as many as the pieces that they show ask for.
    sized = reliable(given.mapInArrow(measure, "id string, source string, cluster string, words long")
                     .withColumn("place", F.when(F.col("id").isNull(), F.monotonically_increasing_id())))
    last = F.floor((F.col("words") - 1) / capacity).cast("int")
    pieces = (sized.filter("words > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
              .select("id", "source", "cluster", "place", "piece", F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("int").alias("n_words")))
    shards = max(1, ceil((sized.filter("words > 0").agg(F.sum(last + 1)).first()[0] or 0) / shard_pieces))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(group, capacity, per_source)
        out["bin_id"] = (key[0] << 32) + out["bin"]
        out["bin_words"] = out.groupby("bin")["n_words"].transform("sum")
        out["first_word"] = out["piece"].astype("int64") * capacity
        return out[["id", "piece", "first_word", "n_words", "bin_id", "bin_words"]]

    packed = (pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "cluster", "place"), F.lit(shards)).cast("long")).drop("place").groupBy("shard")
              .applyInPandas(run, "id string, piece int, first_word long, n_words int, bin_id long, bin_words long"))
    empty = sized.filter("words = 0").selectExpr("id", "0 piece", "0L first_word", "0 n_words", "cast(null as long) bin_id", "cast(null as long) bin_words")
    return packed.unionByName(empty).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
