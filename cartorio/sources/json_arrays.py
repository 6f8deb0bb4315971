"""Large JSON array files in ranges: each range is read on its own, and what it begins inside of is worked out beforehand."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartorio.operators.joins import small
from cartorio.session import materialised, ship

#: Bytes of a range, and ranges whose states are broadcast at most (some 100 bytes each).
RANGE, FEW = 64 << 20, 1_000_000
#: Bytes of small ranges that a task reads one after another, unless there are then fewer than EACH tasks for a core.
TASK, EACH = 64 << 20, 4
QUOTE, ESCAPE, OPEN, CLOSE = b'"'[0], b"\\"[0], b"{"[0], b"}"[0]
#: Bytes that may stand between records.
BETWEEN = np.zeros(256, bool)
BETWEEN[list(b" \t\r\n[],")] = True
MARK = "\ufeff".encode()


@contextmanager
def _ranges_of(spark: SparkSession, size: int) -> Iterator[None]:
    """While this holds, files are cut every `size` bytes, whatever the number of cores."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _pieces(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(path, block, size, value): what stands between closing braces, in the file's order within a range. Spark's text reader cuts
    the file, in any store: a range begins behind the first closing brace in it, and its last piece may end in the next. Small ranges
    are read many by a task, so that their number doesn't tell in tasks."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    ranges, cores = text.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    text = text.coalesce(max(1, min(ranges, max(EACH * cores, ranges * range_bytes // TASK))))
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """((path, block), first row, end) of rows of one range that follow each other."""
    path, block = batch.column("path").to_pylist(), batch.column("block").to_pylist()
    lo = 0
    for i in range(1, len(path) + 1):
        if i == len(path) or (path[i], block[i]) != (path[lo], block[lo]):
            yield (path[lo], block[lo]), lo, i
            lo = i


def _bytes(column: pa.Array, lo: int, hi: int) -> np.ndarray:
    """The rows' bytes with the closing brace behind each again."""
    raw = b"}".join([v.as_buffer().to_pybytes() for v in column.slice(lo, hi - lo).cast(pa.large_binary())])
    return np.frombuffer(raw + b"}", np.uint8)


class Walk:
    """Braces of some bytes that stand outside strings, if they begin outside one (0) or inside (1). A brace closes a piece,
    so what is escaped never lies in the next one."""

    def __init__(self, data: np.ndarray):
        quote = np.flatnonzero(data == QUOTE)
        behind = np.flatnonzero((quote > 0) & (data[quote - 1] == ESCAPE))
        if len(behind):
            escape = np.flatnonzero(data == ESCAPE)
            begin = np.maximum.accumulate(np.where(np.append(True, np.diff(escape) > 1), escape, 0))  # of each one's run
            run = quote[behind] - begin[np.searchsorted(escape, quote[behind] - 1)]
            quote = np.delete(quote, behind[run % 2 == 1])  # an odd number of backslashes stands before it
        self.at = np.flatnonzero((data == OPEN) | (data == CLOSE))
        self.step = np.where(data[self.at] == OPEN, 1, -1)
        self.inside = np.searchsorted(quote, self.at) % 2
        self.quotes = len(quote)

    def outside(self, begins: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, +1 or -1) of the braces that count."""
        keep = self.inside == begins
        return self.at[keep], self.step[keep]


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: bytes, parity of quotes, and for either beginning how far the depth goes up in all and down at least."""
    held: dict[tuple[str, int], list] = {}
    for b in batches:
        for name, lo, hi in _runs(b):
            data = _bytes(b.column("value"), lo, hi)
            walk, now = Walk(data), held.setdefault(name, [b.column("size")[lo].as_py(), 0, 0, 0, 0, 0, 0])
            old = now[2]
            for s in (0, 1):
                depth = np.cumsum(walk.outside(s ^ old)[1])
                total, low = now[3 + 2 * s], now[4 + 2 * s]
                if len(depth):
                    now[3 + 2 * s], now[4 + 2 * s] = total + int(depth[-1]), min(low, total + int(depth.min()))
            now[1] += len(data)
            now[2] = (old + walk.quotes) % 2
    rows = [(*k, *v) for k, v in held.items()]
    names = ["path", "block", "size", "bytes", "quotes", "up0", "low0", "up1", "low1"]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int64()) for i in range(9)], names)


def _states(summary: DataFrame) -> DataFrame:
    """(path, block, inside, depth, since, tail) of each range: whether it begins in a string, in how many open braces, in which
    range the record that it begins in was opened, and whether its last piece has no brace behind it (the file's end).

    A depth never goes below 0: it is the running sum of what the ranges before add, less the least that this sum has been, if under 0.
    """
    by_file = Window.partitionBy("path")
    before = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(c.over(before), F.lit(0).cast("long"))
    r = summary.withColumn("inside", so_far(F.sum("quotes")) % 2)
    r = r.withColumns({c: F.when(F.col("inside") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("up", "low")})
    r = r.withColumn("sum", so_far(F.sum("up")))
    r = r.withColumn("depth", F.col("sum") - F.least(so_far(F.min(F.col("sum") + F.col("low"))), F.lit(0)))
    fresh = (F.col("depth") == 0) | (F.col("depth") + F.col("low") <= 0)
    # With a brace behind the last piece too, the pieces are as long as the file, or three bytes less where a mark at its begin was passed over.
    open_end = (F.sum("bytes").over(by_file) - F.col("size")).isin(1, 1 - len(MARK))
    return r.select("path", "block", "inside", "depth", so_far(F.last(F.when(fresh, F.col("block")), ignorenulls=True)).alias("since"),
                    (open_end & (F.col("block") == F.max("block").over(by_file))).alias("tail"))


class _Range:
    """Records of one range, batch after batch. Parts of records that other ranges have the rest of are told apart."""

    def __init__(self, block: int, inside: int, depth: int, since: int):
        self.block, self.inside, self.depth = block, inside, depth
        self.since = since if depth else None  # of the record that is open now, the range in which it begins
        self.open: list[bytes] = []
        self.rows: list[tuple[str, int, bytes]] = []  # kind, since, text

    def _between(self, data: np.ndarray) -> None:
        if len(data) and not BETWEEN[data].all():
            text = data.tobytes().removeprefix(MARK).strip(b" \t\r\n[],")
            if text:
                self.rows.append(("bad", self.block, text))

    def take(self, data: np.ndarray) -> None:
        walk = Walk(data)
        at, step = walk.outside(self.inside)
        w = self.depth + np.cumsum(step)
        depth = w - np.minimum(0, np.minimum.accumulate(w)) if len(w) else w
        before = np.append(self.depth, depth[:-1]) if len(w) else w
        lo = 0
        for k in np.flatnonzero((before == 0) & (depth == 1) | (before == 1) & (depth == 0)).tolist():
            if depth[k]:
                self._between(data[lo : at[k]])
                self.since, lo = self.block, int(at[k])
            else:
                self.open.append(data[lo : at[k] + 1].tobytes())
                self.rows.append(("whole" if self.since == self.block else "part", self.since, b"".join(self.open)))
                self.since, self.open, lo = None, [], int(at[k]) + 1
        if self.since is None:
            self._between(data[lo:])
        else:
            self.open.append(data[lo:].tobytes())
        self.depth = int(depth[-1]) if len(w) else self.depth
        self.inside = (self.inside + walk.quotes) % 2

    def end(self) -> None:
        if self.open:
            self.rows.append(("part", self.since, b"".join(self.open)))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, name, held = None, None, None  # `held` is the last piece so far, of which only its successor tells that a brace follows
    def told() -> pa.RecordBatch:
        rows, now.rows = now.rows, []
        return pa.RecordBatch.from_arrays([pa.array([name[0]] * len(rows), pa.string()), pa.array([name[1]] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.string()),
                                           pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["path", "block", "kind", "since", "text"])

    def finish() -> Iterator[pa.RecordBatch]:
        if now is not None:
            now.take(held[:-1] if tail else held)
            now.end()
            yield told()

    tail = False
    for b in batches:
        for own, lo, hi in _runs(b):
            if own != name:
                yield from finish()
                state = {c: b.column(c)[lo].as_py() for c in ("inside", "depth", "since", "tail")}
                if state["inside"] is None:
                    raise ValueError(f"{own[0]} at {own[1]}: no state of this range; the file has changed")
                name, tail, now, held = own, state["tail"], _Range(own[1], state["inside"], state["depth"], state["since"]), None
            if held is not None:
                now.take(held)
            if hi - lo > 1:
                now.take(_bytes(b.column("value"), lo, hi - 1))
            held = _bytes(b.column("value"), hi - 1, hi)
            yield told()
    yield from finish()


def json_records(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(record, is_whole): the text of each object of the JSON arrays at path, a file or a folder of any store that Spark reads, in
    ranges of about range_bytes; texts that aren't objects have is_whole false.

    The first scan finds for each range how it changes being in a string, and the depth, for either way to begin; running sums over the
    ranges of a file tell what each does begin in. The second scan cuts records where the depth leaves and reaches 0; only the two ends of
    a range, of which the rest stands in others, are put together by a shuffle. The records are written to the shared folder
    before they're returned, since both scans must cut the files alike.
    """
    ship(spark)
    with _ranges_of(spark, range_bytes):
        pieces = _pieces(spark, path, range_bytes)
        summary = pieces.mapInArrow(_summary, "path string, block bigint, size bigint, bytes bigint, quotes bigint, up0 bigint, low0 bigint, up1 bigint, low1 bigint")
        states = materialised(_states(summary))
        told = pieces.withColumn("pos", F.monotonically_increasing_id()).join(small(states, FEW), ["path", "block"], "left")
        if states.limit(FEW + 1).count() > FEW:  # joined by a shuffle: rows are put in order again
            told = told.repartition("path", "block").sortWithinPartitions("path", "block", "pos")
        rows = told.select("path", "block", "value", "inside", "depth", "since", "tail").mapInArrow(_records, "path string, block bigint, kind string, since bigint, text binary")
        rows = materialised(rows)
    parts = rows.filter("kind = 'part'").groupBy("path", "since").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
    joined = parts.select(F.aggregate(F.col("p.text"), F.lit(b""), lambda a, t: F.concat(a, t)).alias("text"), F.lit(True).alias("is_whole"))
    every = rows.filter("kind <> 'part'").select("text", (F.col("kind") == "whole").alias("is_whole")).unionByName(joined)
    return every.select(F.col("text").cast("string").alias("record"), "is_whole")
