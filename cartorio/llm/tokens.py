"""Token counts of a byte-level BPE by rank-synchronous merging over ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.text import chunks, utf8

# How byte-level vocabularies split a text, and the printable stand-ins of bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Distinct pieces whose counts a worker keeps between batches, and letters of the longest one kept: a bound on memory only.
KEPT, KEPT_LENGTH = 300_000, 64
#: Bytes from which a piece is long: its pairs are held by rank, so that work grows with the merges and not with rounds times length.
LONG = 128


class ByteBpe:
    """Merge ranks of a tokenizer file as sorted arrays: (left, right) pair -> rank, and rank -> merged symbol."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        spare = iter(range(256, 512))
        shown = {b: chr(b) if b in set(PRINTABLE) else chr(next(spare)) for b in range(256)}
        self.byte = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.width = max(vocab.values()) + 1
        keys = left * self.width + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.left, self.right = left, right
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pieces = regex.compile(SPLIT)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the number of ranks where it can't be merged."""
        pair = left * self.width + right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == pair, self.order[at], len(self.keys)) if len(self.keys) else np.zeros(len(pair), np.int64)

    def count_long(self, pieces: list[bytes]) -> np.ndarray:
        """As count_pieces, for long pieces. All pairs stand in lists by rank; the lowest rank is merged in all pieces at once,
        which is each one's lowest that has it, and only pairs beside a merge are ranked anew."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbols = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n, none = len(symbols), len(self.keys)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        after, before, gone = np.arange(1, n + 1), np.arange(-1, n), np.zeros(n, bool)
        ends = np.cumsum(sizes)
        after[ends - 1] = n  # a place of no letter
        before[ends - sizes] = -1
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(at: np.ndarray) -> None:
            at = at[after[at] < n]
            rank = self.ranks(symbols[at], symbols[after[at]])
            at, rank = at[rank < none], rank[rank < none]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            first = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]][: len(rank)])
            for r, some in zip(rank[first].tolist(), np.split(at, first[1:]), strict=True) if len(first) else ():
                if r in waiting:
                    waiting[r].append(some)
                else:
                    waiting[r] = [some]
                    heappush(heap, r)

        put(np.arange(n))
        heapify(heap)
        while heap:
            r = heappop(heap)
            lists = waiting.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[~gone[at] & (symbols[at] == self.left[r]) & (after[at] < n)]
            at = at[symbols[after[at]] == self.right[r]]
            if not len(at):
                continue
            if self.left[r] == self.right[r] and len(at) > 1:  # of a run of overlapping equal pairs (aaa), every other one from the left
                at = np.sort(at)
                run = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            second = after[at]
            gone[second] = True
            symbols[at] = self.made[r]
            after[at] = after[second]
            before[after[at]] = at
            left = before[at]
            put(np.unique(np.concatenate([left[left >= 0], at])))
        return np.bincount(owner[~gone], minlength=len(pieces))

    def count_pieces(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that survive in each piece once no pair can be merged; all pieces advance one rank together."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbols = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        counts = sizes.copy()
        none = len(self.keys)
        while len(symbols) > 1:
            rank = np.where(owner[:-1] == owner[1:], self.ranks(symbols[:-1], symbols[1:]), none)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(np.r_[rank, none], starts)
            live = best < none
            if not live.any():
                break
            lengths = np.diff(np.r_[starts, len(symbols)])
            chosen = np.r_[rank, none] == np.repeat(np.where(live, best, -1), lengths)
            # Of a run of overlapping equal pairs (aaa), every other one from the left is merged.
            where = np.flatnonzero(chosen)
            run = np.flatnonzero(np.r_[True, np.diff(where) != 1])
            within = np.arange(len(where)) - np.repeat(run, np.diff(np.r_[run, len(where)]))
            where = where[within % 2 == 0]
            symbols[where] = self.made[rank[where]]
            keep = np.repeat(live, lengths)
            keep[where + 1] = False
            counts -= np.bincount(owner[where], minlength=len(counts))
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each whole text; special strings count one token each, as the library does by default."""
        totals = np.zeros(len(texts), np.int64)
        lists: list[list[str]] = []
        for i, text in enumerate(texts):
            if not text:
                lists.append([])
                continue
            parts = [text]
            if self.cut and any(s in text for s in self.special):
                parts = self.cut.split(text)
                totals[i] = len(parts) - 1
            found = self.pieces.findall(parts[0])
            for part in parts[1:]:
                found += self.pieces.findall(part)
            lists.append(found)
        if len(self.known) > KEPT:
            self.known.clear()
        known = self.known
        fresh = list(set().union(*lists).difference(known))
        for lo in range(0, len(fresh), 20_000):
            some = fresh[lo : lo + 20_000]
            raw = [p.encode() for p in some]
            for count, own in ((self.count_pieces, [i for i, p in enumerate(raw) if len(p) < LONG]), (self.count_long, [i for i, p in enumerate(raw) if len(p) >= LONG])):
                if own:
                    known.update(zip([some[i] for i in own], count([raw[i] for i in own]).tolist(), strict=True))
        for i, found in enumerate(lists):
            totals[i] += sum(map(known.__getitem__, found))
        for p in fresh:
            if len(p) > KEPT_LENGTH:
                del known[p]
        return totals


_loaded: dict[str, ByteBpe] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text, however long; null is empty, and empty has no tokens.
    `tokenizer` is the path of a byte-level BPE file that executors can open. Each row is counted by itself: repeated rows get equal
    results, null ids stay, no rows give none. Only the two named columns are read, so others may have any name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _loaded:
            _loaded[tokenizer] = ByteBpe(tokenizer)
        bpe = _loaded[tokenizer]
        for b in batches:
            for lo, hi in chunks(utf8(b.column(1))[1]):
                part = b.slice(lo, hi - lo)
                texts = part.column(1).to_pylist()
                n = bpe.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                    ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
