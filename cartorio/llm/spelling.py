"""Spelling variants: words one edit apart, found in sorted lists whose shared prefixes share their edit rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean, parts, reliable
from cartorio.operators.joins import small
from cartorio.session import ship

#: Letters of a run; only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are at least this long and frequent.
SHORTEST, FEWEST = 7, 2
#: Where this divides a run's hash, one of its letters is left out.
MISSPELT = 31
#: A word's form is so many times as frequent at least.
FACTOR = 10
#: Words of a list that one task sorts at most, beyond which lists are divided; rows that Python holds; queries in step.
LIST, ROWS, QUERIES = 20_000, 32_768, 8_192


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): what the runs of letters of whole texts give, of SHORTEST code points and FEWEST occurrences at least. Runs
    of rows without an id are taken as they stand; null and empty texts have none."""
    run = F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    runs = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.explode(run).alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.coalesce(h % MISSPELT == 0, F.lit(False)), less).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= FEWEST))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first or the last half of its free letters fixed as well. Two words of one list that are one
    edit apart keep a list in common: the edit is in one half, and the other is the same in both, counted from its own end."""
    free = F.col("m") - F.col("a") - F.col("z")
    first = F.floor(free / 2).cast("int")
    ends = F.array(F.struct((F.col("a") + first).alias("a"), F.col("z").alias("z")), F.struct(F.col("a").alias("a"), (F.col("z") + free - first).alias("z")))
    out = rows.select("word", "n", "m", F.explode(ends).alias("ends")).select("word", "n", "m", "ends.a", "ends.z")
    key = F.xxhash64("m", "a", "z", F.substring("word", F.lit(1), F.col("a")), F.when(F.col("z") > 0, F.right("word", F.col("z"))).otherwise(""))
    return out.withColumn("key", key)


def lists(words: DataFrame, most: int = LIST) -> DataFrame:
    """(key, m, word, n): each word in the lists in which its near words are too.

    A list is of words of m or m + 1 letters that agree in one half. One with more than `most` words is divided by halves of what is
    free in them, again and again, until at most two letters are; so no list outgrows a task, whatever the words have in common.
    """
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")).filter(F.col("m") >= SHORTEST)
    rows = reliable(_halved(rows.withColumns({"a": F.lit(0), "z": F.lit(0)})))
    out = None
    while True:
        hot = reliable(rows.filter(F.col("m") - F.col("a") - F.col("z") > 2).groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > most).select("key"))
        divide = not hot.isEmpty()
        done = rows.join(small(hot), "key", "left_anti") if divide else rows
        done = done.select("key", "m", "word", "n")
        out = done if out is None else out.unionByName(done)
        if not divide:
            return out
        rows = reliable(_halved(rows.join(small(hot), "key", "left_semi")))


class SortedLists:
    """Sorted words of several lists one after the other: code points, where each word begins, and `shared`, the letters it
    has in common with the word before it in its list (-1 for the first of a list)."""

    def __init__(self, words: list[str], key: np.ndarray):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        n = len(words)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        self.first = np.repeat(begin, np.diff([*begin, n])) if n else begin
        self.last = np.repeat([*begin[1:], n], np.diff([*begin, n])) if n else begin
        self.shared = np.where(new, -1, 0)
        same, depth = np.flatnonzero(~new), 0
        while len(same):
            same = same[(self.length[same] > depth) & (self.length[same - 1] > depth)]
            same = same[self.letters[self.at[same] + depth] == self.letters[self.at[same - 1] + depth]]
            depth += 1
            self.shared[same] = depth

    def letter(self, word: np.ndarray, k: np.ndarray | int) -> np.ndarray:
        """The k-th letters; 0, which none is, where a word has no such letter."""
        inside = (k >= 0) & (k < self.length[word])
        return np.where(inside, self.letters[np.where(inside, self.at[word] + k, 0)], 0)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words of a query's list that are exactly one edit from it.

        The scan goes letter by letter through the words in order. Words with a prefix in common are one range, whose row of the
        edit matrix (three cells around the diagonal, more than one edit is 2) is worked out once; where a row has no cell
        under 2, its range is skipped; a range is divided where a word shares no more than the prefix with the one before.
        """
        q, lo, hi = queries, self.first[queries], self.last[queries]
        row = np.empty((3, len(q)), np.int8)
        row[0], row[1], row[2] = 2, 0, 1
        found: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(q):
            ends = self.length[lo] == depth  # sorted: the word that is the prefix itself comes first in its range
            if ends.any():
                e = np.flatnonzero(ends)
                cell = self.length[q[e]] - depth + 1
                e, cell = e[(cell >= 0) & (cell <= 2)], cell[(cell >= 0) & (cell <= 2)]
                e = e[row[cell, e] == 1]
                found.append((q[e], lo[e]))
                lo = lo + ends
                q, lo, hi, row = self._kept(lo < hi, q, lo, hi, row)
            cuts = np.flatnonzero(self.shared <= depth)
            a, b = np.searchsorted(cuts, lo, "right"), np.searchsorted(cuts, hi, "left")
            count = b - a + 1
            of = np.repeat(np.arange(len(q)), count)
            k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            padded = np.append(cuts, len(self.shared))
            low = np.where(k == 0, lo[of], padded[a[of] + k - 1])
            high = np.where(k == count[of] - 1, hi[of], padded[np.minimum(a[of] + k, len(cuts))])
            q, lo, hi, old = q[of], low, high, row[:, of]
            c, size = self.letter(lo, depth), self.length[q]
            row = np.empty_like(old)
            row[0] = np.minimum(old[0] + (c != self.letter(q, depth - 1)), old[1] + 1)
            row[1] = np.minimum(np.minimum(old[1] + (c != self.letter(q, depth)), old[2] + 1), row[0] + 1)
            row[2] = np.minimum(old[2] + (c != self.letter(q, depth + 1)), row[1] + 1)
            depth += 1
            for j in range(3):
                row[j, depth - 1 + j > size] = 2
            np.minimum(row, 2, out=row)
            q, lo, hi, row = self._kept(row.min(axis=0) < 2, q, lo, hi, row)
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate([empty, *(f[k] for f in found)]) for k in (0, 1))

    @staticmethod
    def _kept(keep: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        return (q, lo, hi, row) if keep.all() else (q[keep], lo[keep], hi[keep], row[:, keep])


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole lists, some ROWS each (or one longer list), of words that are alike in length."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= ROWS:
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut = n - int(np.argmax(np.append(key[::-1] != key[-1], True)))
            yield from _alike(table.slice(0, cut))
            rest = table.slice(cut)
            held, n = rest.to_batches(), rest.num_rows
    if n:
        yield from _alike(pa.Table.from_batches(held))


def _alike(table: pa.Table) -> Iterator[pa.Table]:
    """Pieces of a table sorted by m within which the longest words are at most twice as long as the shortest."""
    m = table.column("m").to_numpy()
    lo = 0
    while lo < len(m):
        hi = int(np.searchsorted(m, 2 * m[lo], "right"))
        yield table.slice(lo, hi - lo)
        lo = hi


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_lists(batches):
        table = table.combine_chunks()
        words, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
        own = SortedLists(words.to_pylist(), table.column("key").to_numpy())
        asked = np.flatnonzero(own.last - own.first > 1)
        for lo in range(0, len(asked), QUERIES):
            q, w = own.near(asked[lo : lo + QUERIES])
            yield pa.RecordBatch.from_arrays([words.take(pa.array(q)), n.take(pa.array(q)), words.take(pa.array(w)), n.take(pa.array(w))], ["word", "n", "near", "near_n"])


def near_words(words: DataFrame, most: int = LIST) -> DataFrame:
    """(word, n, near, near_n): each pair of different words one edit apart, both ways, once."""
    rows = lists(words, most)
    ship(words.sparkSession)
    sorted_ = lean(rows.repartition(parts(words.sparkSession), "key").sortWithinPartitions("m", "key", "word").select("key", "m", "word", "n"))
    return sorted_.mapInArrow(_pairs, "word string, n bigint, near string, near_n bigint").distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. Counts grow tenfold with each, so steps are few; each
    round doubles how far every word sees."""
    ahead = reliable(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        out = reliable(ahead.join(further, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        if out.filter("moved").isEmpty():
            return out.select("word", "root")
        ahead = out.select("word", "root")


def group(docs: DataFrame, factor: int = FACTOR, most: int = LIST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of all texts, how many words are one edit away, and the one they are
    taken to stand for: the most frequent near one (of equal ones the first by code points) if it is `factor` times as frequent.

    Null and empty texts have no words, rows that repeat count each, rows without an id are never misspelt, no rows give none,
    further columns don't matter, and runs of any length are taken whole.
    """
    words = reliable(vocabulary(docs, id_col, text_col))
    best = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(best, "word", "left")
    is_form: Column = -F.col("best.less") >= factor * F.col("n")
    out = reliable(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
                              F.when(is_form, -F.col("best.less")).alias("form_n")))
    roots = _followed(out.filter("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
