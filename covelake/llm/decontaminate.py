"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become sequences of lower-cased words without punctuation. Running Karp-Rabin
hashes of ``min_match`` = 5 words seed matches; for every document and item that share a seed, the
longest match of unmarked words is marked again and again until none of ``min_match`` words is left (of equal
matches, that which stands first in the item, then in the document). The share of the item's words under marks, in
whatever order the pieces stand, is its coverage; ``threshold`` = 0.8 or more reports the document. Items shorter than
``min_match`` words must occur whole.

Memory is bounded whatever the texts repeat. A document's distinct seeds tell how much of an item could be covered at
most, and only pairs that could reach the threshold are tiled. Pairs of equal seeds are expanded ``CHUNK`` at a time and
kept as maximal diagonals; if these are more than ``DIAGONALS``, the longest are tiled first and the rest found again
among what is still unmarked.

The benchmark is the query set: it goes to the tasks in blocks of at most ``block_bytes`` of text, one broadcast and one
pass over the documents a block, and a block's result is written before the next is read, so that the driver and
the tasks hold one block at a time, whatever the benchmark grows to; the documents are never shuffled.

Edge cases: null and empty texts and items without words match nothing; long texts are tiled whole; rows without a
doc_id are reported with a null one; items without an item_id are left out; repeated documents are each reported; copies
of one item are each reported; empty tables yield no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, lean, materialise, small_batches, text_slices
from covelake.llm.kernels import LOWER, NOT_WORD, Prefix, mix, spans

SCHEMA = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long, coverage double"
FILTER_BITS = 20
#: Pairs of equal seeds expanded at once, and diagonals kept of a document and an item.
CHUNK, DIAGONALS = 1 << 20, 1 << 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets by text)."""
    low = LOWER[data]
    start, end, owner = spans(low, offsets, NOT_WORD)
    words = np.bincount(owner, minlength=len(offsets) - 1) if len(owner) else np.zeros(len(offsets) - 1, np.int64)
    return mix(Prefix(low).range(start, end)) if len(start) else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(words)]).astype(np.int64)


def seeds(tok: np.ndarray, k: int) -> np.ndarray:
    """Running hash of every ``k`` words."""
    n = len(tok) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tok[j : j + n]
    return mix(out)


def _diagonals(at: np.ndarray, lo: np.ndarray, n: np.ndarray, pos: np.ndarray, used_i: np.ndarray, used_j: np.ndarray, k: int, longest: int):
    """Maximal runs (words, item, document) of unmarked pairs of equal seeds, below ``longest`` words, some at a time.

    The document's place ``at[x]`` has a seed that the item has at ``pos[lo[x] : lo[x] + n[x]]``; ``used_*`` count marked words.
    """
    free = used_j[at + k] == used_j[at]
    at, lo, n = at[free], lo[free], n[free]
    ends = np.cumsum(n)
    open_ = np.zeros((3, 0), np.int64)  # runs that may go on: diagonal, start in the document, end in it
    i = 0
    while i < len(at):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHUNK, "right")))
        part = slice(i, j)
        back = np.repeat(np.arange(j - i), n[part])
        x = pos[lo[part][back] + np.arange(len(back)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])]
        y = at[part][back]
        free = used_i[x + k] == used_i[x]
        x, y = x[free], y[free]
        order = np.lexsort((y, y - x))
        x, y = x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (np.diff(x) != 1) | (np.diff(y) != 1)
        first = np.flatnonzero(new)
        runs = np.stack([y[first] - x[first], y[first], y[first] + np.diff(np.append(first, len(x)))]) if len(x) else np.zeros((3, 0), np.int64)
        # runs of the chunk before that end where this one begins go on, on the same diagonal
        both = np.concatenate([open_, runs], 1)
        both = both[:, np.lexsort((both[1], both[0]))]
        new = np.ones(both.shape[1], bool)
        new[1:] = (np.diff(both[0]) != 0) | (both[1][1:] != both[2][:-1])
        first = np.flatnonzero(new)
        both = np.stack([both[0][first], both[1][first], both[2][np.append(first[1:], both.shape[1]) - 1]]) if len(first) else both
        live = both[2] > at[j - 1] if j < len(at) and at[j] == at[j - 1] + 1 else np.zeros(both.shape[1], bool)
        open_, done = both[:, live], both[:, ~live]
        size = done[2] - done[1] + k - 1
        keep = size < longest
        yield size[keep], (done[1] - done[0])[keep], done[1][keep]
        i = j


def tile(words: int, length: int, at: np.ndarray, lo: np.ndarray, n: np.ndarray, pos: np.ndarray, k: int) -> tuple[int, int]:
    """(words of the item covered, tiles) of an item of ``words`` and a document of ``length`` words: longest unmarked match first."""
    marked_i, marked_j = np.zeros(words, bool), np.zeros(length, bool)
    covered = tiles = 0
    longest = words + 1
    while True:
        counts = [np.concatenate([[0], np.cumsum(m)]) for m in (marked_i, marked_j)]
        held, total, least = [np.zeros((3, 0), np.int64)], 0, 0
        for part in _diagonals(at, lo, n, pos, *counts, k, longest):
            held.append(np.stack(part))
            total += len(part[0])
            if total > 2 * DIAGONALS:  # keep the longest, whole classes of length only
                all_ = np.concatenate(held, 1)
                least = max(least, int(np.partition(all_[0], -DIAGONALS)[-DIAGONALS]))
                held = [all_[:, all_[0] >= least]]
                total = held[0].shape[1]
        runs = np.concatenate(held, 1)
        runs = runs[:, runs[0] >= least]
        runs = runs[:, np.lexsort((runs[2], runs[1], -runs[0]))]
        heap: list[tuple[int, int, int]] = []  # what is left of matches, besides those in order
        row, left = 0, _room(marked_i, k)
        while left and (row < runs.shape[1] or heap):
            if heap and (row == runs.shape[1] or heap[0] <= (-int(runs[0, row]), int(runs[1, row]), int(runs[2, row]))):
                size, a, b = heapq.heappop(heap)
                size = -size
            else:
                size, a, b = (int(v) for v in runs[:, row])
                row += 1
            taken = marked_i[a : a + size] | marked_j[b : b + size]
            if taken.any():  # what is left of the match competes again
                edge = np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8))
                for s, e in zip(np.flatnonzero(edge == -1).tolist(), np.flatnonzero(edge == 1).tolist(), strict=True):
                    if e - s >= max(k, least):
                        heapq.heappush(heap, (s - e, a + s, b + s))
                continue
            marked_i[a : a + size] = marked_j[b : b + size] = True
            covered += size
            tiles += 1
            left = _room(marked_i, k)
        if not left or least <= k:
            return covered, tiles
        longest = least  # shorter ones are found again among what is unmarked


def _room(marked: np.ndarray, k: int) -> bool:
    """Are there ``k`` unmarked words in a row?"""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], marked, [True]]).astype(np.int8)))
    return bool(len(edge)) and int((edge[1::2] - edge[::2]).max()) >= k


class Index:
    """Seeds of a block of items, those of short items apart."""

    def __init__(self, ids: list[int], texts: list[bytes], k: int):
        self.k, self.ids = k, ids
        data = np.frombuffer(b"".join(texts), np.uint8)
        tok, off = tokens(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
        self.words = np.diff(off)
        self.by_size = {}
        for size in sorted({min(k, n) for n in self.words.tolist() if n}):
            own = [n for n, m in enumerate(self.words.tolist()) if min(k, m) == size]
            hashes = [seeds(tok[off[n] : off[n + 1]], size) for n in own]
            h = np.concatenate(hashes)
            item = np.repeat(own, [len(x) for x in hashes])
            pos = np.concatenate([np.arange(len(x)) for x in hashes])
            order = np.lexsort((pos, item, h))
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[h >> np.uint64(64 - FILTER_BITS)] = True
            h, item, pos = h[order], item[order], pos[order]
            group = np.searchsorted(h, h, "left")  # the first entry of each entry's seed
            by = np.lexsort((pos, group, item))
            self.by_size[size] = (h, item, pos, seen, group[by], pos[by], np.searchsorted(item[by], np.arange(len(self.words) + 1)))

    def matches(self, tok: np.ndarray, off: np.ndarray, threshold: float):
        """(document, item, covered, tiles) for every document that covers ``threshold`` or more of an item."""
        for size, (h, item, pos, seen, groups, places, cut) in self.by_size.items():
            s = seeds(tok, size)
            at = np.flatnonzero(seen[s >> np.uint64(64 - FILTER_BITS)])
            lo = np.searchsorted(h, s[at], "left")
            hit = h[np.minimum(lo, len(h) - 1)] == s[at]
            at, lo = at[hit], lo[hit]
            doc = np.searchsorted(off, at, side="right") - 1
            inside = at + size <= off[doc + 1]
            at, lo, doc = at[inside], lo[inside], doc[inside]
            for d in np.unique(doc).tolist():
                a, b = np.searchsorted(doc, d), np.searchsorted(doc, d, "right")
                place, low = at[a:b] - off[d], lo[a:b]
                for m in self._could(np.unique(low), h, item, pos, size, threshold):
                    own = slice(cut[m], cut[m + 1])
                    first, last = np.searchsorted(groups[own], low, "left"), np.searchsorted(groups[own], low, "right")
                    some = np.flatnonzero(last > first)
                    covered, tiles = tile(int(self.words[m]), int(off[d + 1] - off[d]), place[some], first[some], (last - first)[some], places[own], size)
                    if covered >= threshold * self.words[m] - 1e-9:
                        yield d, m, covered, tiles

    def _could(self, low: np.ndarray, h: np.ndarray, item: np.ndarray, pos: np.ndarray, size: int, threshold: float) -> list[int]:
        """Items of which the distinct seeds with first entries ``low`` could cover ``threshold``; at most one look at each entry."""
        n = np.searchsorted(h, h[low], "right") - low
        entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        order = np.lexsort((pos[entry], item[entry]))
        own, place = item[entry][order], pos[entry][order]
        new = np.ones(len(own), bool)
        new[1:] = np.diff(own) != 0
        step = np.full(len(own), size)  # words that a seed adds up to the next one
        step[:-1] = np.where(new[1:], size, np.minimum(np.diff(place), size))
        first = np.flatnonzero(new)
        items = own[first]
        return items[np.add.reduceat(step, first) >= threshold * self.words[items] - 1e-9].tolist()


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, min_match: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """One row for every document and benchmark item of which the document holds ``threshold`` or more."""
    small_batches(docs.sparkSession)
    out = None
    for shared, last in _blocks(benchmark, min_match, block_bytes):
        part = _scan(docs, shared, threshold)
        if not last or out is not None:
            part = materialise(part, "block")
            shared.unpersist()
        out = part if out is None else out.union(part)
    return out


def _blocks(benchmark: DataFrame, min_match: int, block_bytes: int):
    """(broadcast index, whether it is the last) of each block of the benchmark."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text")).where("item_id is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size * 2 // block_bytes))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # a block of the query set
        index = Index([r.item_id for r in rows], [bytes(r.text) for r in rows], min_match)
        yield benchmark.sparkSession.sparkContext.broadcast(index), b == blocks - 1


def _scan(docs: DataFrame, shared, threshold: float) -> DataFrame:
    def run(batches):
        index = shared.value
        for batch in batches:
            data, off = binary_column(batch, "text")
            ids = batch.column(0)
            found: list[tuple] = []
            for i, j in text_slices(off):
                tok, at = tokens(data[off[i] : off[j]], off[i : j + 1] - off[i])
                for d, m, covered, tiles in index.matches(tok, at, threshold):
                    n = int(index.words[m])
                    found.append((ids[i + d].as_py(), index.ids[m], n, covered, tiles, covered / n))
            cols = list(zip(*found, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "coverage"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, min_match: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows whose text holds no benchmark item, each judged by itself, whatever its doc_id; columns unchanged."""
    small_batches(docs.sparkSession)
    schema, many = docs.schema, False
    for shared, last in _blocks(benchmark, min_match, block_bytes):

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                data, off = binary_column(batch, "text")
                keep = np.ones(len(off) - 1, bool)
                for i, j in text_slices(off):
                    tok, at = tokens(data[off[i] : off[j]], off[i : j + 1] - off[i])
                    keep[[i + d for d, *_ in index.matches(tok, at, threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(lean(run), schema)
        if many or not last:
            docs, many = materialise(docs, "clean"), True
            shared.unpersist()
    return docs
