"""Suffix-array dedup: bytes in strings of a given length that also start in a document with a smaller id.

1. Every window of `length` bytes has an anchor, its least hashed 16-gram; equal windows have equal anchors at equal
   places. Runs of windows with one anchor are found in numpy, and anchors that two documents share are resolved where
   they meet: in the map task, or else in a bucket of the anchor's hash.
2. Each bucket of documents folds the equal strings under shared anchors (a run of windows, below twice the length) and
   sends every different one once, with the least document that has it there, to its anchor's bucket.
3. There, of anchors that have several strings, all stretches of windows that another string may hold (both ends' grams stand
   in another one too) are sorted by suffix_orders(); equal windows stand next to each other, are compared byte by byte, and get the least id of all documents that hold them. The answers go back to the buckets of documents.
4. Anchors in very many documents go window by window instead: Spark aggregates the least document of each different window, with
   a row for each window and task at most, and joins it to the buckets that asked.
5. Each bucket of documents finds its own occurrences again and puts the windows that a smaller id holds together to spans.

So no occurrence leaves its bucket of documents, however many documents share a string. Buckets are of bytes, and grow in
number with the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean, reliable
from cartorio.llm.suffix_order import suffix_orders
from cartorio.llm.text import BASE, BASE_INVERSE, chunks, mix, powers, utf8

GRAM = 16
#: The upper 48 bits of an anchor's hash are its key.
KEY_BITS = np.uint64(~0xFFFF & (1 << 64) - 1)
#: Bytes of text in a bucket, about; anchors that a map task gathers before it passes them on; letters sorted at once.
BUCKET_BYTES, GATHERED, SORTED_AT_ONCE = 4 << 20, 1_500_000, 2_000_000
#: Windows that are matched at once, and strings that are looked at together, of an anchor that can't be sorted at once.
WINDOWS_AT_ONCE, ROWS_AT_ONCE = 2_000_000, 16_384
#: Anchors in more documents than this go window by window: at most (all anchors / HOT) are told to every task.
HOT = 1_000_000


_SEED = np.random.default_rng(50)
_BYTES = [_SEED.integers(0, 1 << 63, 256, dtype=np.uint64) for _ in range(2)]


def _prime(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return max(n, 2)


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window's start in the row, windows, anchor's hash) of each run of windows with one anchor."""
    n, wide = len(data), length - GRAM + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    gram = mix((total[GRAM:] - total[:-GRAM]) * powers(BASE_INVERSE, n)[: n - GRAM + 1])
    del total
    # Least by the upper 40 bits and then by place; rows are cut so that places fit below.
    least = (gram & ~np.uint64(0xFFFFFF)) | np.arange(len(gram), dtype=np.uint64)
    have = 1
    while 2 * have <= wide:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < wide:
        least = np.minimum(least[: len(least) - (wide - have)], least[wide - have :])
    place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    valid = np.flatnonzero(np.arange(len(place)) + length <= offsets[1:][row])
    if not len(valid):
        return empty, empty, empty, empty.astype(np.uint64)
    place, row = place[valid], row[valid]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    windows = np.diff(np.r_[first, len(valid)])
    return row[first], valid[first] - offsets[row[first]], windows, gram[place[first]] & KEY_BITS


def pieces(offsets: np.ndarray, length: int, most: int = 1 << 20) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """(rows, from, to) of stretches of text of about `most` bytes together; a longer text comes in several, which
    overlap by length - 1 bytes, so that each window is whole in one."""
    rows, lows, highs, size = [], [], [], 0
    for r in range(len(offsets) - 1):
        lo, end = int(offsets[r]), int(offsets[r + 1])
        while end - lo >= length:
            hi = min(end, lo + most)
            rows.append(r)
            lows.append(lo)
            highs.append(hi)
            size += hi - lo
            if size >= most:
                yield rows, lows, highs
                rows, lows, highs, size = [], [], [], 0
            if hi == end:
                break
            lo = hi - length + 1
    if rows:
        yield rows, lows, highs


_RUNS = ["part", "known", "key", "doc", "start", "windows"]
_RUNS_SCHEMA = "part int, known boolean, key binary, doc binary, start binary, windows binary"


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest of 1, 2, 4 or 8 bytes each, which the first byte tells; 8 signed, the others not."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    width = 8 if low < 0 else next(w for w in (1, 2, 4, 8) if high < 1 << (8 * w))
    return bytes([width]) + x.astype(_WIDTHS[width] if low < 0 or width < 8 else np.uint64).tobytes()


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _WIDTHS[raw[0]], offset=1).astype(np.int64)


_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}


def _packed(part: int, known: bool, key: np.ndarray, doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple:
    """Of a key, 48 bits: a clash of two anchors only costs a look at them."""
    parts = key.astype(np.uint64)[:, None].view(np.uint8)[:, 2:] if len(key) else np.zeros(0, np.uint8)
    return (part, known, parts.tobytes(), narrow(doc), narrow(start), narrow(windows))


def _keys(table: pa.Table) -> np.ndarray:
    raw = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return out.view(np.uint64).ravel()


def _split(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(part, kind="stable")
    part = part[order]
    for some in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
        if len(some):
            yield int(part[some[0]]), *(c[order[some]] for c in columns)


def _runs_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], _RUNS)


def _joined(table: pa.Table, column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(widen(x) for x in table.column(column).to_pylist())])


def shared_runs(docs: DataFrame, length: int, buckets: int, hot: int) -> DataFrame:
    """Packed runs, by the id's bucket, whose anchor two documents share; part -1: anchors of over `hot` documents."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, doc, start, windows = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((doc, key))
            key, doc, start, windows = key[order], doc[order], start[order], windows[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            count = np.diff(np.r_[first, len(key)])
            several = doc[first] != doc[first + count - 1]
            local = np.repeat(several, count)
            met = np.add.reduceat(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])].astype(np.int64), first)
            # Shared in this task already: on to their documents; one row tells the anchor's bucket.
            out = [_packed(buckets + p, False, *c) for p, *c in _split(doc[local] % buckets, key[local], doc[local], start[local], windows[local])]
            k = key[first][several]
            out += [_packed(p, True, a, b, np.zeros(0), np.zeros(0)) for p, a, b in _split(((k >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64), k, met[several])]
            one = ~local
            out += [_packed(p, False, *c) for p, *c in _split(((key[one] >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64), key[one], doc[one], start[one], windows[one])]
            held.clear()
            yield _runs_batch(out)

        for b in batches:
            data, offsets = utf8(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for rows, lows, highs in pieces(offsets, length):
                part = np.concatenate([data[lo:hi] for lo, hi in zip(lows, highs, strict=True)])
                bounds = np.r_[0, np.cumsum(np.subtract(highs, lows))]
                row, start, windows, key = anchored_runs(part, bounds, length)
                at = np.array(rows)[row] if len(row) else row
                held.append((key, ids[at], start + (np.array(lows) - offsets[rows])[row], windows))
                size += len(key)
                if size >= GATHERED:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def resolve(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part >= buckets:
            out = [_packed(part - buckets, False, _keys(table), *(_joined(table, c) for c in _RUNS[3:]))]
            return pa.Table.from_batches([_runs_batch(out)])
        known = table.filter(table.column("known"))
        single = table.filter(pa.compute.invert(table.column("known")))
        k, met = _keys(known), _joined(known, "doc")
        key, (doc, start, windows) = _keys(single), (_joined(single, c) for c in _RUNS[3:])
        every, who = np.concatenate([key, k]), np.concatenate([doc, np.full(len(k), -1)])
        number = np.concatenate([np.zeros(len(key), np.int64), met])
        order = np.lexsort((who, every))
        every, who, number = every[order], who[order], number[order]
        if not len(every):
            return pa.Table.from_batches([_runs_batch([])])
        fresh = np.r_[True, every[1:] != every[:-1]]
        first = np.flatnonzero(fresh)
        count = np.diff(np.r_[first, len(every)])
        told = np.add.reduceat(number, first)
        docs_of = told + np.add.reduceat(((np.r_[True, who[1:] != who[:-1]] | fresh) & (number == 0)).astype(np.int64), first)
        shared = (told > 0) | (docs_of > 1)
        use = np.repeat(shared, count) & (number == 0)
        pick = order[use]
        out = [_packed(p, False, *c) for p, *c in _split(doc[pick] % buckets, key[pick], doc[pick], start[pick], windows[pick])]
        over = every[first][docs_of > hot]
        if len(over):
            out.append(_packed(-1, False, over, np.zeros(0), np.zeros(0), np.zeros(0)))
        return pa.Table.from_batches([_runs_batch(out)])

    return docs.select("id", "text").mapInArrow(gather, _RUNS_SCHEMA).groupBy("part").applyInArrow(resolve, _RUNS_SCHEMA)


#: A bucket's questions: different strings and the least document of each, by the anchor's bucket.
_ASKS = ["part", "origin", "size", "content", "number", "least"]
_ASKS_SCHEMA = "part int, origin int, size binary, content binary, number binary, least binary"
#: What goes back to a bucket of documents: strings by number, and for each the owner of all its windows or of every one.
_ANSWERS_SCHEMA = "part int, kind int, a binary, b binary, c binary, d binary"
_ANSWERS = ["part", "kind", "a", "b", "c", "d"]
RUNS, STRINGS, WINDOWS = 0, 1, 2
_TEXTS_SCHEMA = "part int, id binary, size binary, content binary"


def packed_texts(docs: DataFrame) -> DataFrame:
    """Texts (id, text, part) as compressed blocks by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            raw = data.tobytes()
            ids, part = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), b.column(2).to_numpy()
            pack = zstandard.ZstdCompressor(level=1).compress
            out = [(p, narrow(ids[rows]), narrow(np.diff(offsets)[rows]), pack(b"".join(raw[offsets[r] : offsets[r + 1]] for r in rows)))
                   for p, rows in _split(part, np.arange(b.num_rows))]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int32(), *[pa.binary()] * 3], strict=True)], ["part", "id", "size", "content"])

    return docs.select("id", "text", "part").mapInArrow(run, _TEXTS_SCHEMA)


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bytes, offsets) of a bucket's texts."""
    body = b"".join(zstandard.decompress(x) for x in table.column("content").to_pylist())
    return _joined(table, "id"), np.frombuffer(body, np.uint8), np.r_[0, np.cumsum(_joined(table, "size"))]


class Occurrences:
    """Strings of runs in a bucket of texts: `begin`, `end` (bytes in the bucket's data), `doc`, `start`, `windows`, `key`.

    `number`: equal strings have equal ones, in the order of their hashes, the same whenever the bucket is looked at; `first`: an
    occurrence of each number."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, start: np.ndarray, begin: np.ndarray, windows: np.ndarray, data: np.ndarray, length: int):
        self.key, self.doc, self.start, self.begin, self.windows = key, doc, start, begin, windows
        self.end = begin + windows + length - 1
        self.number, self.first = numbered(data, self.begin, self.end)


def numbered(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each stretch of the data, equal for equal ones; a stretch of each number), by two hashes of 64 bits."""
    hashes = [np.zeros(len(begin), np.uint64) for _ in _BYTES]
    by, lo = np.argsort(begin, kind="stable"), 0
    sorted_ = begin[by]
    while lo < len(by):  # about a MiB of data at a time
        hi = int(np.searchsorted(sorted_, sorted_[lo] + (1 << 20)))
        own = by[lo:hi]
        part = data[sorted_[lo] : end[own].max()]
        first, last = begin[own] - sorted_[lo], end[own] - sorted_[lo]
        for h, values in zip(hashes, _BYTES, strict=True):
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * powers(BASE, len(part)), out=total[1:])
            h[own] = mix((total[last] - total[first]) * powers(BASE_INVERSE, len(part) + 1)[first] + (last - first).astype(np.uint64))
        lo = hi
    order = np.lexsort(hashes)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[0][order[1:]] != hashes[0][order[:-1]]) | (hashes[1][order[1:]] != hashes[1][order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number, order[fresh]


def occurrences(key: np.ndarray, doc: np.ndarray, start: np.ndarray, windows: np.ndarray, texts: tuple[np.ndarray, np.ndarray, np.ndarray], length: int,
                hot: np.ndarray) -> tuple[Occurrences, Occurrences]:
    """Strings of the runs of a bucket, and single windows of those under hot anchors."""
    ids, data, offsets = texts
    by_id = np.argsort(ids, kind="stable")
    at = by_id[np.minimum(np.searchsorted(ids[by_id], doc), max(len(ids) - 1, 0))] if len(ids) else np.zeros(0, np.int64)
    if not len(ids):
        key, doc, start, windows = key[:0], doc[:0], start[:0], windows[:0]
    begin = offsets[at] + start
    ok = (ids[at] == doc) & (begin + windows + length - 1 <= offsets[at + 1])
    wide = np.isin(key, hot) & ok
    ok &= ~wide
    many = windows[wide]
    inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    each = lambda x: np.repeat(x[wide], many)
    return (Occurrences(key[ok], doc[ok], start[ok], begin[ok], windows[ok], data, length),
            Occurrences(each(key), each(doc), each(start) + inner, each(begin) + inner, np.ones(len(inner), np.int64), data, length))


def _runs_of(table: pa.Table) -> tuple[np.ndarray, ...]:
    return _keys(table), *(_joined(table, c) for c in _RUNS[3:])


def _least(o: Occurrences) -> np.ndarray:
    least = np.full(len(o.first), np.iinfo(np.int64).max)
    np.minimum.at(least, o.number, o.doc)
    return least


def questions(runs: DataFrame, texts: DataFrame, length: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Packed strings under shared anchors, by the anchor's bucket: each that a bucket of documents has, once."""

    def cut(table: pa.Table, text: pa.Table) -> pa.Table:
        out = []
        if table.num_rows and text.num_rows:
            texts = _texts(text)
            o, _ = occurrences(*_runs_of(table), texts, length, hot)
            least, raw = _least(o), texts[1].tobytes()
            number = np.argsort(o.key[o.first], kind="stable")  # strings of one anchor side by side
            lead = o.first[number]
            parts = ((o.key[lead] >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
            pack = zstandard.ZstdCompressor(level=1).compress
            for p, n, begin, end in _split(parts, number, o.begin[lead], o.end[lead]):
                body = b"".join([raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)])
                out.append((p, table.column("part")[0].as_py(), narrow(end - begin), pack(body), narrow(n), narrow(least[n])))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        return pa.table([pa.array(c, k) for c, k in zip(cols, [pa.int32(), pa.int32(), *[pa.binary()] * 4], strict=True)], names=_ASKS)

    return runs.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(cut, _ASKS_SCHEMA)


def hot_answers(runs: DataFrame, texts: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """Answers for single windows under hot anchors, by aggregation over all buckets that have them."""

    def cut(table: pa.Table, text: pa.Table) -> pa.Table:
        number, content, least, part = np.zeros(0, np.int64), [], np.zeros(0, np.int64), 0
        if table.num_rows and text.num_rows:
            texts = _texts(text)
            _, o = occurrences(*_runs_of(table), texts, length, hot)
            raw, least, part, number = texts[1].tobytes(), _least(o), table.column("part")[0].as_py(), np.arange(len(o.first))
            content = [raw[x : x + length] for x in o.begin[o.first].tolist()]
        return pa.table([pa.array(np.full(len(number), part), pa.int32()), pa.array(number), pa.array(content, pa.binary()), pa.array(least)], names=["part", "number", "content", "least"])

    asked = reliable(runs.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(cut, "part int, number long, content binary, least long"))
    owners = asked.groupBy("content").agg(F.min("least").alias("owner"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(p, WINDOWS, narrow(n), narrow(np.ones(len(n), np.int64)), narrow(w), b"")
                   for p, n, w in _split(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy())]
            yield _answers(out).to_batches()[0]

    return asked.join(owners, "content").select("part", "number", "owner").mapInArrow(pack, _ANSWERS_SCHEMA)


def _answers(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.table([pa.array(c, k) for c, k in zip(cols, [pa.int32(), pa.int32(), *[pa.binary()] * 4], strict=True)], names=_ANSWERS)


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; beyond the end zeros."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out |= wide[j : j + len(data)] << np.uint64(8 * j)
    return out


def shared_stretches(contents: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, windows): stretches of windows that another string may hold.

    A window of another string with the same anchor has equal grams at both its ends, at the same places from the
    anchor; windows of whose end grams only one string has any are left out, and with them most of what differs from
    copy to copy.
    """
    n = len(contents)
    sizes = np.array([len(c) for c in contents])
    width = 2 * length
    body = np.zeros((n, width), np.uint8)
    body[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(contents), np.uint8)
    grams = width - GRAM + 1
    h = np.zeros((n, grams), np.uint64)
    for j in reversed(range(GRAM)):
        h = h * BASE + (body[:, j : j + grams].astype(np.uint64) + np.uint64(1))
    h = mix(h)
    # The anchor, as anchored_runs() has it: all windows of a string share the first one's.
    anchor = (h[:, : length - GRAM + 1] & ~np.uint64(0xFFFFFF)).argmin(1)
    own = mix(h[np.arange(n), anchor])
    place = np.arange(grams)[None, :] - anchor[:, None] + width
    token = mix(h ^ own[:, None] ^ mix(place.astype(np.uint64)))
    inside = np.arange(grams)[None, :] <= (sizes - GRAM)[:, None]
    _, back, times = np.unique(token[inside], return_inverse=True, return_counts=True)
    often = np.zeros((n, grams), bool)
    often[inside] = times[back] > 1
    windows = sizes - length + 1
    w = np.arange(length + 1)
    good = often[:, : len(w)] & often[:, length - GRAM : length - GRAM + len(w)] & (w[None, :] < windows[:, None])
    edge = np.diff(np.pad(good, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    string, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return string, first, stop - first


def owners(contents: list[bytes], anchor: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each string (a row) and each window in it (a column) the least of the numbers (`least`, the strings' own) of any string
    under the same anchor that holds the window. Strings of one anchor stand side by side.

    Stretches of windows that another string may hold are sorted: equal windows are neighbours in the order of all suffixes of an
    anchor's stretches, and are compared byte by byte. An anchor with over SORTED_AT_ONCE letters, of which no task could hold the
    order, has its windows matched by hashes, WINDOWS_AT_ONCE of them at a time, and compared byte by byte as well."""
    full = np.repeat(least[:, None], length, 1)
    sizes = np.array([len(c) for c in contents])
    for lo, hi in _blocks(anchor, sizes):
        if sizes[lo:hi].sum() > SORTED_AT_ONCE:
            _match_owners(contents[lo:hi], least[lo:hi], length, full[lo:hi])
            continue
        string, first, windows = shared_stretches(contents[lo:hi], length)
        string += lo
        for a, b in _blocks(anchor[string], windows + length):
            _order_owners([contents[r][x : x + w + length - 1] for r, x, w in zip(string[a:b].tolist(), first[a:b].tolist(), windows[a:b].tolist())], anchor[string[a:b]],
                          string[a:b], first[a:b], least, length, full)
    return full


def _match_owners(contents: list[bytes], least: np.ndarray, length: int, full: np.ndarray) -> None:
    """Puts the owners of all windows of one anchor's strings into `full`, in memory of some hundred bytes a string: windows are
    dealt to parts by their ends, equal ones to one, and a part is sorted by hash."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join([*contents, bytes(8)]), np.uint8)
    begin, windows = np.cumsum(sizes) - sizes, sizes - length + 1
    eight = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
    steps = (*range(0, length - 8, 8), length - 8)
    ends = np.cumsum(windows)
    parts = np.uint64(-(-int(ends[-1]) // WINDOWS_AT_ONCE))
    part = np.empty(ends[-1], np.uint8 if parts < 256 else np.uint16 if parts < 65536 else np.uint32)
    for lo in range(0, len(contents), ROWS_AT_ONCE):
        w = windows[lo : lo + ROWS_AT_ONCE]
        at = np.repeat(begin[lo : lo + len(w)] - np.cumsum(w) + w, w) + np.arange(w.sum())
        part[ends[lo] - w[0] : ends[lo + len(w) - 1]] = mix(eight[at] ^ mix(eight[at + length - 8])) % parts
    for p in range(int(parts)):
        own = np.flatnonzero(part == p)
        if not len(own):
            continue
        row = np.searchsorted(ends, own, "right").astype(np.int32)
        inner = (own - ends[row] + windows[row]).astype(np.int32)
        at = begin[row] + inner
        h = np.zeros(len(at), np.uint64)
        for k in steps:
            h = mix(h + eight[at + k])
        order = np.argsort(h, kind="stable")
        same = _equal(eight, at[order], steps)
        if (same < (h[order[1:]] == h[order[:-1]])).any():  # two windows with one hash: by their bytes instead
            order = np.lexsort([eight[at + k] for k in steps])
            same = _equal(eight, at[order], steps)
        heads = np.flatnonzero(np.r_[True, ~same])
        low = np.minimum.reduceat(least[row[order]], heads)
        full[row[order], inner[order]] = np.repeat(low, np.diff(np.r_[heads, len(order)]))


def _equal(eight: np.ndarray, at: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Whether each window is the next one too."""
    same = np.ones(max(len(at) - 1, 0), bool)
    for k in steps:
        same &= eight[at[1:] + k] == eight[at[:-1] + k]
    return same


def _blocks(group: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of whole groups, which stand side by side, of about SORTED_AT_ONCE together; or one larger group."""
    heads = np.r_[np.flatnonzero(np.diff(group) != 0) + 1, len(group)] if len(group) else group
    total, lo = np.cumsum(sizes), 0
    while lo < len(group):
        most = (total[lo - 1] if lo else 0) + SORTED_AT_ONCE
        fits = heads[(heads > lo) & (total[heads - 1] <= most)]
        hi = int(fits[-1]) if len(fits) else int(heads[heads > lo][0])
        yield lo, hi
        lo = hi


def _order_owners(stretches: list[bytes], anchor: np.ndarray, string: np.ndarray, offset: np.ndarray, least: np.ndarray, length: int, full: np.ndarray) -> None:
    """Puts the owners of the windows of stretches (of `string`, from `offset` on) into `full`."""
    sizes = np.array([len(c) for c in stretches])
    text = np.frombuffer(b"\0".join([*stretches, b""]), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    row = np.repeat(np.arange(len(stretches)), sizes + 1)
    usable = np.arange(len(text)) + length <= (begin + sizes)[row]
    eight = _words8(text)
    number = text.astype(np.int64) + 1
    number[begin + sizes] = 0
    first = np.r_[begin[np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])], len(text)]
    order = suffix_orders(number, first)
    order = order[usable[order]]
    of = np.searchsorted(first, order, "right")
    same = of[1:] == of[:-1]
    for j in (*range(0, length - 8, 8), length - 8):
        at = np.flatnonzero(same)
        same[at] = eight[order[at] + j] == eight[order[at + 1] + j]
    heads = np.flatnonzero(np.r_[True, ~same])
    low = np.minimum.reduceat(least[string[row[order]]], heads)
    full[string[row[order]], offset[row[order]] + order - begin[row[order]]] = np.repeat(low, np.diff(np.r_[heads, len(order)]))


def _anchors(contents: list[bytes], length: int) -> np.ndarray:
    """The key of each string's anchor, as anchored_runs() has it."""
    out = np.zeros(len(contents), np.uint64)
    for lo, hi in chunks(np.r_[0, np.cumsum([len(c) for c in contents])]):
        some = contents[lo:hi]
        row, _, _, key = anchored_runs(np.frombuffer(b"".join(some), np.uint8), np.r_[0, np.cumsum([len(c) for c in some])], length)
        out[lo + row[::-1]] = key[::-1]
    return out


def answers(asked: DataFrame, length: int) -> DataFrame:
    """For each bucket that asked: its strings' numbers, and the least document of all that holds each window: one where
    it's the same for all windows of a string."""

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        body = np.frombuffer(b"".join(zstandard.decompress(r["content"]) for r in rows), np.uint8)
        each = [widen(r["size"]) for r in rows]
        ends = np.cumsum(np.concatenate([np.zeros(0, np.int64), *each]))
        begin = np.r_[0, ends[:-1]].astype(np.int64)[: len(ends)]
        string, first = numbered(body, begin, ends)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, string, np.concatenate([np.zeros(0, np.int64), *(widen(r["least"]) for r in rows)]))
        raw = body.tobytes()
        contents = [raw[x:y] for x, y in zip(begin[first].tolist(), ends[first].tolist(), strict=True)]
        windows = (ends - begin)[first] - length + 1
        ids, rank = np.unique(least, return_inverse=True)  # owners are told by small numbers
        rank, count = rank.astype(np.int32), np.ones(len(first), np.int64)
        owner, place = rank, np.arange(len(first))
        # Anchors with one string left have nothing to sort: its windows belong to its least document.
        anchor = _anchors(contents, length)
        _, back, times = np.unique(anchor, return_inverse=True, return_counts=True)
        several = np.flatnonzero(times[back] > 1) if len(first) else np.zeros(0, np.int64)
        several = several[np.argsort(anchor[several], kind="stable")]
        if len(several):
            full = owners([contents[k] for k in several], anchor[several], rank[several], length)
            varied = np.concatenate(
                [lo + np.flatnonzero((full[lo : lo + ROWS_AT_ONCE] != full[lo : lo + ROWS_AT_ONCE, :1]).any(1, where=np.arange(length) < windows[several[lo : lo + ROWS_AT_ONCE], None]))
                 for lo in range(0, len(several), ROWS_AT_ONCE)])
            count[several[varied]] = windows[several[varied]]
            place = np.cumsum(count) - count
            owner = np.empty(count.sum(), np.int32)
            owner[place] = rank
            owner[place[several]] = full[:, 0]
            for lo in range(0, len(varied), ROWS_AT_ONCE):
                some = varied[lo : lo + ROWS_AT_ONCE]
                n = windows[several[some]]
                at = np.repeat(place[several[some]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                owner[at] = full[some][np.arange(length) < n[:, None]]
        out, at = [], 0
        for r, sizes in zip(rows, each, strict=True):
            mine = string[at : at + len(sizes)]
            at += len(sizes)
            n = count[mine]
            flat = np.repeat(place[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append((r["origin"], STRINGS, r["number"], narrow(n), narrow(ids[owner[flat]]), b""))
        return _answers(out)

    return asked.groupBy("part").applyInArrow(judge, _ANSWERS_SCHEMA)


def gone(o: Occurrences, answer: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of each window that a smaller document holds."""
    number, n, owner = (_joined(answer, c) for c in "abc")
    first, many = np.zeros(len(o.first), np.int64), np.zeros(len(o.first), np.int64)
    first[number], many[number] = np.cumsum(n) - n, n
    known = many[o.number] > 0
    windows = np.where(known, o.windows, 0)
    of = np.repeat(np.arange(len(windows)), windows)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    hit = o.doc[of] > owner[first[o.number[of]] + np.where(many[o.number[of]] > 1, inner, 0)] if len(of) else np.zeros(0, bool)
    return o.doc[of][hit], (o.start[of] + inner)[hit]


def kept(data: np.ndarray, at: np.ndarray, length: int) -> tuple[list[tuple[int, int]], bytes]:
    """(spans that go, remaining bytes) of one text, by the windows that go."""
    at = np.unique(at[at + length <= len(data)])  # rows that repeat an id have each twice
    change = np.zeros(len(data) + 1, np.int8)
    change[at] += 1
    change[at + length] -= 1
    gone = np.cumsum(change[:-1], dtype=np.int8) > 0
    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), data[~gone].tobytes()


def dedup(docs: DataFrame, length: int = 50, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) of every document, its whole text taken as UTF-8 bytes.

    A byte goes when a string of `length` bytes (from 32 to 64) covers it that also starts in a document with a
    smaller id; strings are judged on the input and never cross documents. Ids are integers, and unique: rows that
    repeat an id share their spans. Null texts are empty; rows with a null id keep all bytes and match nothing; no rows
    give none. Only the two named columns are read, so others may have any name.
    """
    if not 32 <= length <= 64:
        raise ValueError("length must be from 32 to 64")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    given = lean(docs).select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    size = given.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = _prime(max(1, -(-size // BUCKET_BYTES)))
    texts = given.filter("id is not null").withColumn("part", F.pmod("id", F.lit(buckets)).cast("int"))
    runs = reliable(shared_runs(texts, length, buckets, hot))
    over = np.sort(_keys(runs.filter("part = -1").select("key").toArrow()))
    runs = runs.filter("part >= 0")
    blocks = packed_texts(texts)
    found = answers(questions(runs, blocks, length, buckets, over), length).unionByName(
        runs.select("part", F.lit(RUNS).alias("kind"), F.col("key").alias("a"), F.col("doc").alias("b"), F.col("start").alias("c"), F.col("windows").alias("d")))
    if len(over):
        found = found.unionByName(hot_answers(runs, blocks, length, over))

    def finish(table: pa.Table, text: pa.Table) -> pa.Table:
        texts = ids, data, offsets = _texts(text)
        kinds = table.column("kind").to_numpy()
        of = lambda k: table.filter(pa.array(kinds == k))
        own = occurrences(*_runs_of(of(RUNS).select(["a", "b", "c", "d"]).rename_columns(_RUNS[2:])), texts, length, over)
        doc, start = (np.concatenate(c) for c in zip(gone(own[0], of(STRINGS)), gone(own[1], of(WINDOWS)), strict=True))
        order = np.argsort(doc, kind="stable")
        doc, start = doc[order], start[order]
        out = []
        for r, x in enumerate(ids.tolist()):
            own = data[offsets[r] : offsets[r + 1]]
            lo, hi = np.searchsorted(doc, [x, x + 1])
            spans, rest = kept(own, start[lo:hi], length) if hi > lo else ([], own.tobytes())
            out.append((x, len(own), len(own) - len(rest), [{"start": s, "end": e} for s, e in spans], hashlib.sha256(rest).hexdigest()))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), span, pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "spans", "kept_sha256"])

    schema = "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    done = found.groupBy("part").cogroup(blocks.groupBy("part")).applyInArrow(finish, schema)
    loose = given.filter("id is null").selectExpr("id", "cast(octet_length(text) as long) n_bytes", "0L n_removed",
                                                  "cast(array() as array<struct<start:long,end:long>>) spans", "sha2(text, 256) kept_sha256")
    return done.unionByName(loose).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
