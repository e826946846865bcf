"""Removal of long repeated passages with a logarithmic family of suffix arrays.

Every byte under a string of ``min_len`` = 100 bytes that also starts earlier (in a document with a smaller
doc_id, or earlier in the same one) is removed. All texts are UTF-8 bytes; matches never cross documents.

``Family`` keeps suffix arrays, i.e. windows in the lexicographic order of their ``min_len`` bytes, of geometric
sizes: a new batch of windows is sorted, merge-scanned against every level for windows as long as a match, and added;
levels of equal size merge, so there are at most log2(n).

The windows of a corpus are too many to sort at one place, and most need no comparison, so they travel in groups. In
every window the K-byte string with the least hash is the window's anchor: equal windows have equal anchors.
Neighbouring windows with the same anchor form one group.

1. A pair (anchor, content of the group) is shuffled for each group, dealt by anchor: groups that repeat one as a whole
   go. A hot passage is reduced in every task before it is shuffled: only its first place in the task travels.
2. What is left are distinct contents. Those whose anchor occurs with other contents as well, i.e. the edges of repeated
   passages, send their bytes, dealt by anchor again, and the family of the task finds their repeated windows.

Strings that anchor many contents (a stub of a license in ever new surroundings) would deal a large part of the corpus to
one task. Those often met in a sample come last in the choice of anchors, so windows that hold any other string are dealt
by that; only windows of nothing but such strings, i.e. of one common passage, keep them.

Edge cases: null and empty texts are rows with nothing removed; texts under ``min_len`` bytes are never
touched; texts of any length are processed in pieces; rows that share a doc_id are ordered by text, each
keeps its own row, and rows without doc_id come first; an empty table yields no rows; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, bucket_keys, fresh, lean, materialise, partitions_for, small_batches, text_slices
from covelake.llm.kernels import Prefix, mix, sliding_min

U64 = np.uint64
ANCHOR = 32
PIECE = 1 << 18
#: Groups that a task gathers before it reduces and sends them; bytes of edges that it gathers before it sends them.
FLUSH, EDGE_FLUSH = 200_000, 8 << 20
#: Documents of the sample in which anchors are counted, contents from which on an anchor counts as often met, and how many of those are kept.
SAMPLE, OFTEN, OFTEN_KEPT = 4000, 16, 100_000
MOVED = "key int, kind int, blob binary"
GROUP, REMOVED, EDGE, TEXT, BYTES = range(5)


class Family:
    """Suffix arrays of geometric sizes over windows of ``size`` bytes of one buffer: has an equal window come earlier?"""

    def __init__(self, data: np.ndarray, size: int):
        self.word = np.zeros(len(data), U64)  # the eight bytes from every place; words compare as bytes do
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        for k in range(8):
            self.word = (self.word << U64(8)) | padded[k : k + len(data)]
        self.steps = [*range(0, size - 8, 8), size - 8]
        self.levels: list[np.ndarray] = []

    def sort(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array of the windows ``at``, and which of them differ from the one before; equal ones keep their order."""
        order = at[np.argsort(self.word[at], kind="stable")]
        head = np.ones(len(order), bool)
        head[1:] = np.diff(self.word[order]) != 0
        for step in self.steps[1:]:
            tied = ~head
            tied[:-1] |= ~head[1:]
            live = np.flatnonzero(tied)
            if not len(live):
                break
            run, word = np.cumsum(head)[live], self.word[order[live] + step]
            inner = np.lexsort((word, run))
            order[live], word = order[live][inner], word[inner]
            new = np.ones(len(live), bool)
            new[1:] = (np.diff(word) != 0) | (np.diff(run) != 0)
            head[live] |= new
        return order, head

    def _compare(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(less, equal) of the windows at ``a`` against those at ``b``."""
        less, left = np.zeros(len(a), bool), np.arange(len(a))
        for step in self.steps:
            x, y = self.word[a[left] + step], self.word[b[left] + step]
            less[left[x < y]] = True
            left = left[x == y]
            if not len(left):
                break
        equal = np.zeros(len(a), bool)
        equal[left] = True
        return less, equal

    def lower(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where in ``level`` the first window stands that isn't less than that at ``at``."""
        first = self.word[level]
        lo, hi = np.searchsorted(first, self.word[at], "left"), np.searchsorted(first, self.word[at], "right")
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less, _ = self._compare(level[mid], at[live])
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        return lo

    def scan(self, at: np.ndarray) -> np.ndarray:
        """Which of the sorted windows ``at`` stand in a level."""
        found = np.zeros(len(at), bool)
        for level in self.levels:
            left = np.flatnonzero(~found)
            where = self.lower(level, at[left])
            left, where = left[where < len(level)], where[where < len(level)]
            found[left] = self._compare(level[where], at[left])[1]
        return found

    def add(self, level: np.ndarray) -> None:
        """A new level of distinct, sorted windows; levels no larger than it merge with it."""
        while self.levels and len(self.levels[-1]) <= len(level):
            older = self.levels.pop()
            level = np.insert(older, self.lower(older, level), level)
        self.levels.append(level)


def repeated(data: np.ndarray, at: np.ndarray, size: int, batch: int = 1 << 18) -> np.ndarray:
    """Which of the windows ``at`` of ``size`` bytes, given in order, have an equal one before them? Batches go through a Family."""
    out, family = np.zeros(len(data), bool), Family(data, size)
    for i in range(0, len(at), batch):
        order, head = family.sort(at[i : i + batch])
        out[order[~head]] = True
        order = order[head]
        old = family.scan(order)
        out[order[old]] = True
        family.add(order[~old])
    return out[at]


def pieces(offsets: np.ndarray, min_len: int):
    """(start, end, offsets within, rows, places within the rows): runs of whole texts, or parts of long ones that overlap by min_len - 1."""
    for i, j in text_slices(offsets, PIECE):
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= 2 * PIECE:
            yield a, b, offsets[i : j + 1] - a, np.arange(i, j), np.zeros(j - i, np.int64)
        else:
            for c in range(0, b - a, PIECE):
                e = min(b - a, c + PIECE + min_len - 1)
                if e - c >= min_len:
                    yield a + c, a + e, np.array([0, e - c]), np.array([i]), np.array([c])


def groups(data: np.ndarray, off: np.ndarray, min_len: int, often: np.ndarray):
    """(anchor hash, content hash, text, first window, windows) of all groups of windows in concatenated texts.

    Strings whose (sorted) hashes are in ``often`` become anchors only of windows that hold nothing else.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < min_len:
        return none.astype(U64), none.astype(U64), none, none, none
    grams = mix(Prefix(data, 7).grams(ANCHOR)) if n > ANCHOR else None
    bits = U64(21)
    key = ((grams >> U64(1)) & ~((U64(1) << bits) - U64(1))) | np.arange(len(grams), dtype=U64)
    if len(often):
        seen = np.zeros(1 << 20, bool)
        seen[often >> U64(44)] = True
        maybe = np.flatnonzero(seen[grams >> U64(44)])
        last = maybe[often[np.minimum(np.searchsorted(often, grams[maybe]), len(often) - 1)] == grams[maybe]]
        key[last] |= U64(1 << 63)
    low = sliding_min(key, min_len - ANCHOR)
    anchor = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(anchor)]
    ok = np.flatnonzero(np.arange(len(anchor)) + min_len <= off[text + 1])
    if not len(ok):
        return none.astype(U64), none.astype(U64), none, none, none
    cut = np.ones(len(ok), bool)
    cut[1:] = (np.diff(ok) != 1) | (np.diff(anchor[ok]) != 0)
    first = np.flatnonzero(cut)
    size = np.diff(np.append(first, len(ok)))
    lo = ok[first]
    content = mix(Prefix(data, 11).range(lo, lo + size + min_len - 1) + size.astype(U64))
    return grams[anchor[lo]], content, text[lo], lo - off[text[lo]], size


# The anchor hash covers ANCHOR bytes at each of min_len - ANCHOR places: windows end before the last byte matters,
# so a window's anchor is taken over its first min_len - 1 bytes; equal windows still have equal anchors.


def pack(*arrays: np.ndarray) -> bytes:
    """Columns of equal length, bytes of like weight together, so that the shuffle's codec finds the zeros."""
    n = len(arrays[0])
    out = [np.array([n], np.int64).tobytes()]
    for a in arrays:
        a = a.astype(np.int64) if a.dtype.kind == "i" else a
        if a.dtype.kind == "i" and n:
            a = np.diff(a, prepend=np.int64(0))
        out.append(np.ascontiguousarray(a.view(np.uint8).reshape(n, 8).T).tobytes())
    import zstandard

    return zstandard.compress(b"".join(out), 1)


def unpack(blob: bytes, signed: str) -> list[np.ndarray]:
    """``signed``: a letter a column, i or u."""
    import zstandard

    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    out = []
    for k, kind in enumerate(signed):
        a = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8 + 8 * n * k).reshape(8, n).T).reshape(-1)
        out.append(np.cumsum(a.view(np.int64)) if kind == "i" else a.view(U64))
    return out


def gather(blobs: list[bytes], signed: str) -> list[np.ndarray]:
    parts = [unpack(b, signed) for b in blobs]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64 if k == "i" else U64) for k in signed]


def merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals of each document; touching ones join."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    head = np.ones(len(doc), bool)
    head[1:] = doc[1:] != doc[:-1]
    run = np.cumsum(head) - 1
    span = np.int64(max(int(end.max()), 1)) + 1
    reach = np.maximum.accumulate(end + run * span) - run * span  # furthest end so far in the document
    new = head.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last]


def rows_by_bucket(keys: np.ndarray, bucket: np.ndarray, kind: int, *cols: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(len(keys) + 1))
    for k in np.flatnonzero(np.diff(cut)):
        part = order[cut[k] : cut[k + 1]]
        yield int(keys[k]), kind, pack(*(c[part] for c in cols))


def batches_of(rows, size: int = 64):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows):
    key, kind, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], ["key", "kind", "blob"])


def doc_bucket(doc: np.ndarray, n: int) -> np.ndarray:
    return (mix(doc.view(U64)) % U64(n)).astype(np.int64)


def _collect(batches) -> dict[int, list[bytes]]:
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            held.setdefault(kind, []).append(blob)
    return held


def send_groups(n: int, min_len: int, often: np.ndarray):
    keys = bucket_keys(n)

    def reduce(parts):
        h, s, doc, lo, size = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((lo, doc, s, h))
        h, s, doc, lo, size = h[order], s[order], doc[order], lo[order], size[order]
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
        d, a, b = merge(doc[again], lo[again], lo[again] + size[again] + min_len - 1)
        yield from rows_by_bucket(keys, doc_bucket(d, n), REMOVED, d, a, b)
        h, s, doc, lo, size = (c[~again] for c in (h, s, doc, lo, size))
        order = np.lexsort((lo, doc))
        h, s, doc, lo, size = (c[order] for c in (h, s, doc, lo, size))
        yield from rows_by_bucket(keys, ((h >> U64(24)) % U64(n)).astype(np.int64), GROUP, h, s, doc, lo, size)

    def rows(batches):
        parts, held = [], 0
        for batch in batches:
            data, off = binary_column(batch, "text")
            sid = np.array(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            for a, b, within, row, place in pieces(off, min_len):
                h, s, text, lo, size = groups(data[a:b], within, min_len, often)
                parts.append((h, s, sid[row[text]], lo + place[text], size))
                held += len(h)
                if held > FLUSH:
                    yield from reduce(parts)
                    parts, held = [], 0
        if held:
            yield from reduce(parts)

    return lambda batches: batches_of(rows(batches))


def match_groups(n: int, min_len: int, since: int | None = None):
    """Groups that repeat one as a whole, and edges; with ``since`` also the distinct groups of documents from there on, to be kept."""
    keys = bucket_keys(n)

    def rows(batches):
        held = _collect(batches)
        h, s, doc, lo, size = gather(held.get(GROUP, []), "uuiii")
        order = np.lexsort((lo, doc, s, h))
        h, s, doc, lo, size = (c[order] for c in (h, s, doc, lo, size))
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
        parts = gather(held.get(REMOVED, []), "iii")
        own = (doc[again], lo[again], lo[again] + size[again] + min_len - 1)
        d, a, b = merge(*(np.concatenate(c) for c in zip(parts, own, strict=True)))
        yield from rows_by_bucket(keys, doc_bucket(d, n), REMOVED, d, a, b)
        h, s, doc, lo, size = (c[~again] for c in (h, s, doc, lo, size))
        if since is not None and len(doc):
            new = np.flatnonzero(doc >= since)
            yield int(keys[0]), GROUP, pack(h[new], s[new], doc[new], lo[new], size[new])
        same = h[1:] == h[:-1]
        edge = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(h) else np.zeros(0, np.int64)
        yield from rows_by_bucket(keys, doc_bucket(doc[edge], n), EDGE, h[edge], doc[edge], lo[edge], size[edge])

    return lambda batches: batches_of(rows(batches))


def send_texts(n: int):
    """The texts themselves, compressed, dealt by document."""
    keys = bucket_keys(n)

    def rows(batches):
        import zstandard

        for batch in batches:
            data, off = binary_column(batch, "text")
            sid = np.array(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            ids = batch.column(1)
            bucket = doc_bucket(sid, n)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(n + 1))
            for k in np.flatnonzero(np.diff(cut)):
                part = order[cut[k] : cut[k + 1]]
                take = ids.take(pa.array(part))
                none = np.array(take.is_null().to_numpy(zero_copy_only=False))
                head = np.stack([sid[part], np.array(take.fill_null(0).to_numpy(zero_copy_only=False), np.int64), none.astype(np.int64), off[part + 1] - off[part]])
                body = b"".join(data[off[p] : off[p + 1]].tobytes() for p in part)
                yield int(keys[k]), TEXT, zstandard.compress(np.int64(len(part)).tobytes() + head.tobytes() + body, 1)

    return lambda batches: batches_of(rows(batches))


def texts_of(blobs: list[bytes]):
    import zstandard

    for blob in blobs:
        raw = zstandard.decompress(blob)
        n = int(np.frombuffer(raw[:8], np.int64)[0])
        head = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
        at = 8 + 32 * n
        for sid, doc, none, size in head.T.tolist():
            yield sid, None if none else doc, raw[at : at + size]
            at += size


def send_edges(n: int, min_len: int):
    """The bytes of edge groups, dealt by anchor."""
    import zstandard

    keys = bucket_keys(n)

    def send(held):
        bucket = np.array([b for b, *_ in held])
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(n + 1))
        for k in np.flatnonzero(np.diff(cut)):
            part = [held[i] for i in order[cut[k] : cut[k + 1]]]
            head = pack(*(np.array(c, np.int64) for c in zip(*(p[1:4] for p in part), strict=True)))
            yield int(keys[k]), BYTES, np.int64(len(head)).tobytes() + head + zstandard.compress(b"".join(p[4] for p in part), 1)

    def rows(batches):
        held = _collect(batches)
        h, doc, lo, size = gather(held.get(EDGE, []), "uiii")
        order = np.lexsort((lo, doc))
        bucket, doc, lo, size = ((h[order] >> U64(24)) % U64(n)).astype(np.int64), doc[order], lo[order], size[order]
        out, total = [], 0
        for sid, _, text in texts_of(held.pop(TEXT, [])):
            i, j = np.searchsorted(doc, sid), np.searchsorted(doc, sid, "right")
            for b, a, k in zip(bucket[i:j].tolist(), lo[i:j].tolist(), size[i:j].tolist(), strict=True):
                out.append((b, sid, a, k, text[a : a + k + min_len - 1]))
                total += k + min_len - 1
                if total > EDGE_FLUSH:
                    yield from send(out)
                    out, total = [], 0
        if out:
            yield from send(out)

    return lambda batches: batches_of(rows(batches))


def match_edges(n: int, min_len: int):
    """Repeated windows of the edge groups of a task's anchors, by suffix arrays."""
    import zstandard

    keys = bucket_keys(n)

    def rows(batches):
        heads, bodies = [], []
        for blob in _collect(batches).get(BYTES, []):
            k = int(np.frombuffer(blob[:8], np.int64)[0])
            heads.append(blob[8 : 8 + k])
            bodies.append(zstandard.decompress(blob[8 + k :]))
        if not heads:
            return
        doc, lo, size = gather(heads, "iii")
        data = np.frombuffer(b"".join(bodies), np.uint8)
        del bodies
        ends = np.cumsum(size + min_len - 1)
        base = ends - (size + min_len - 1)
        order = np.lexsort((lo, doc))
        doc, lo, size, base = doc[order], lo[order], size[order], base[order]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        again = np.flatnonzero(repeated(data, np.repeat(base, size) + inside, min_len))
        doc, start = np.repeat(doc, size)[again], (np.repeat(lo, size) + inside)[again]
        d, a, b = merge(doc, start, start + min_len)
        yield from rows_by_bucket(keys, doc_bucket(d, n), REMOVED, d, a, b)

    return lambda batches: batches_of(rows(batches))


RESULT = "sid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut_texts(with_text: bool):
    def rows(batches):
        held = _collect(batches)
        d, s, e = merge(*gather(held.get(REMOVED, []), "iii"))
        out, held_bytes = [], 0
        for sid, doc, text in texts_of(held.pop(TEXT, [])):
            i, j = np.searchsorted(d, sid), np.searchsorted(d, sid, "right")
            kept, at = [], 0
            for a, b in zip(s[i:j].tolist(), e[i:j].tolist(), strict=True):
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            rest = b"".join(kept)
            row = (sid, doc, len(text), len(text) - len(rest), int(j - i), hashlib.sha256(rest).hexdigest())
            out.append((*row, rest.decode("utf-8", errors="ignore")) if with_text else row)
            held_bytes += len(rest) if with_text else 0
            if len(out) == 512 or held_bytes > EDGE_FLUSH:
                yield out
                out, held_bytes = [], 0
        if out:
            yield out

    names = ["sid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    kinds = [pa.int64()] * 5 + [pa.string()] * (1 + with_text)

    def run(batches):
        for out in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def common_anchors(base: DataFrame, min_len: int) -> np.ndarray:
    """Sorted hashes of the strings that anchor ``OFTEN`` and more contents in a sample of ``base(sid, text)``."""

    def run(batches):
        for batch in batches:
            data, off = binary_column(batch, "text")
            for a, b, within, _, _ in pieces(off, min_len):
                h, s, *_ = groups(data[a:b], within, min_len, np.zeros(0, U64))
                order = np.lexsort((s, h))
                h, s = h[order], s[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
                h, k = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[k > 1].view(np.int64)), pa.array(k[k > 1])], ["h", "k"])

    total = base.count()
    some = base.where(F.pmod(F.xxhash64("sid"), F.lit(1 << 20)) < (1 << 20) * min(1.0, SAMPLE / max(total, 1)))
    found = some.select("text").mapInArrow(lean(run), "h long, k long").groupBy("h").agg(F.sum("k").alias("k")).where(f"k >= {OFTEN}").orderBy(F.desc("k"), "h").limit(OFTEN_KEPT)
    return np.sort(found.toPandas()["h"].to_numpy(np.int64).view(U64))


def _with_sid(docs: DataFrame, sid: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``sid``, a key of each row in the order of ids and texts: the id itself where ids are distinct and none is null."""
    key = docs[id_col].cast("long")
    if docs.select(key.alias("id")).groupBy("id").count().where("count > 1 or id is null").isEmpty():
        return docs.withColumn(sid, key)
    return materialise(docs.orderBy(key, docs[text_col].cast("string")).withColumn(sid, F.monotonically_increasing_id()), "ordered")


def suffix_dedup(docs: DataFrame, min_len: int = 100, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text: the rest, without broken characters)."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _cleaned(_with_sid(base, "sid"), min_len, with_text).drop("sid")


def _cleaned(base: DataFrame, min_len: int, with_text: bool) -> DataFrame:
    """The rows of ``suffix_dedup`` with their sid, of ``base(sid, doc_id, text)``."""
    if min_len <= ANCHOR + 1:
        raise ValueError(f"min_len must exceed {ANCHOR + 1}")
    small_batches(base.sparkSession)
    n = partitions_for(base)
    often = common_anchors(base, min_len)
    found = base.select("sid", "text").mapInArrow(lean(send_groups(n, min_len, often)), MOVED)
    found = materialise(found.repartition(n, "key").mapInArrow(lean(match_groups(n, min_len)), MOVED), "groups")
    texts = base.select("sid", "doc_id", "text").mapInArrow(lean(send_texts(n)), MOVED)
    edges = texts.union(found.where(f"kind = {EDGE}")).repartition(n, "key").mapInArrow(lean(send_edges(n, min_len)), MOVED)
    more = materialise(edges.repartition(n, "key").mapInArrow(lean(match_edges(n, min_len)), MOVED), "windows")
    removed = found.where(f"kind = {REMOVED}").union(more)
    return texts.union(removed).repartition(n, "key").mapInArrow(lean(cut_texts(with_text)), RESULT + ", kept_text string" * with_text)


KEPT = "h long, s long, sid long, lo long, size long"


def _unpacked(batches):
    """Kept groups as rows."""
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            cols = unpack(blob, "uuiii")
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], [f.split()[0] for f in KEPT.split(", ")])


def _stored_groups(n: int):
    """Kept groups, dealt by anchor like new ones."""
    keys = bucket_keys(n)

    def rows(batches):
        for batch in batches:
            h, s, doc, lo, size = (np.array(c.to_numpy(zero_copy_only=False), np.int64) for c in batch.columns)
            order = np.lexsort((lo, doc))
            h, s, doc, lo, size = (c[order] for c in (h.view(U64), s.view(U64), doc, lo, size))
            yield from rows_by_bucket(keys, ((h >> U64(24)) % U64(n)).astype(np.int64), GROUP, h, s, doc, lo, size)

    return lambda batches: batches_of(rows(batches))


class Corpus:
    """A corpus that grows by batches, kept as levels of geometric sizes in a shared folder.

    ``add`` matches a batch against every level, and within itself, as ``suffix_dedup`` does: a byte goes if its string also
    starts in an earlier batch, or earlier in this one. The batch then becomes a level, and levels of equal size merge. A
    level is the distinct groups that it brought and its texts, of which only those with edges are read again. The list
    of levels is written last, so a batch that failed leaves the corpus as it was.
    """

    SHIFT = 50  # bits of a row's key below the number of its batch

    def __init__(self, spark: SparkSession, path: str, min_len: int = 100):
        self.spark, self.path, self.min_len = spark, path.rstrip("/"), min_len

    def levels(self) -> tuple[int, list[tuple[str, int]], list[int]]:
        """(batches so far, levels as (folder, rows), common anchors of the first batch, which all batches keep)."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
        done = [x for x in names if x.startswith("state-") and fs.exists(hadoop.Path(f"{self.path}/{x}/_SUCCESS"))]
        if not done:
            return 0, [], []
        r = self.spark.read.schema("batches int, levels array<struct<folder string, rows long>>, often array<long>").json(f"{self.path}/{max(done)}").first()
        return r.batches, [(x.folder, x.rows) for x in r.levels], list(r.often)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of ``suffix_dedup`` for the batch, which is then part of the corpus."""
        small_batches(self.spark)
        number, levels, often = self.levels()
        since, name = (number + 1) << self.SHIFT, f"{number + 1:06d}-{uuid.uuid4().hex[:8]}"
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).orderBy("doc_id", "text")
        rows.withColumn("sid", F.monotonically_increasing_id() + F.lit(since)).write.parquet(f"{self.path}/level-{name}/texts")
        base = self.spark.read.parquet(f"{self.path}/level-{name}/texts")
        n = partitions_for(base)
        hashes = np.array(often, np.int64).view(U64) if number else common_anchors(base, self.min_len)
        sent = base.select("sid", "text").mapInArrow(lean(send_groups(n, self.min_len, np.sort(hashes))), MOVED)
        for folder, _ in levels:
            sent = sent.union(self.spark.read.schema(KEPT).parquet(f"{self.path}/{folder}/groups").mapInArrow(lean(_stored_groups(n)), MOVED))
        found = materialise(sent.repartition(n, "key").mapInArrow(lean(match_groups(n, self.min_len, since)), MOVED), "groups")
        found.where(f"kind = {GROUP}").select("blob").mapInArrow(lean(_unpacked), KEPT).write.parquet(f"{self.path}/level-{name}/groups")
        edges = found.where(f"kind = {EDGE}")
        asked = edges.select("blob").mapInArrow(lean(_edge_docs(since)), "sid long").distinct()
        texts = base.select("sid", "doc_id", "text")
        old = [self.spark.read.parquet(f"{self.path}/{folder}/texts").join(asked, "sid", "left_semi").select("sid", "doc_id", "text") for folder, _ in levels]
        for part in old:
            texts = texts.union(part)
        moved = texts.mapInArrow(lean(send_texts(n)), MOVED)
        sent = moved.union(edges).repartition(n, "key").mapInArrow(lean(send_edges(n, self.min_len)), MOVED)
        more = materialise(sent.repartition(n, "key").mapInArrow(lean(match_edges(n, self.min_len)), MOVED), "windows")
        own = base.select("sid", "doc_id", "text").mapInArrow(lean(send_texts(n)), MOVED)
        removed = found.where(f"kind = {REMOVED}").union(more)
        out = materialise(own.union(removed).repartition(n, "key").mapInArrow(lean(cut_texts(False)), RESULT), "cut").drop("sid")
        self._commit(number + 1, levels, (f"level-{name}", base.count()), hashes)
        return out

    def _commit(self, number: int, levels: list[tuple[str, int]], new: tuple[str, int], often: np.ndarray) -> None:
        while levels and levels[-1][1] <= new[1]:
            older = levels.pop()
            folder = f"level-{number:06d}-{uuid.uuid4().hex[:8]}"
            for part in ("groups", "texts"):
                self.spark.read.parquet(f"{self.path}/{older[0]}/{part}").unionByName(self.spark.read.parquet(f"{self.path}/{new[0]}/{part}")).write.parquet(f"{self.path}/{folder}/{part}")
            new = (folder, older[1] + new[1])
        state = self.spark.createDataFrame([(number, [*levels, new], often.view(np.int64).tolist())], "batches int, levels array<struct<folder string, rows long>>, often array<long>")
        state.coalesce(1).write.json(f"{self.path}/state-{number:06d}")


def _edge_docs(since: int):
    def run(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                doc = np.unique(unpack(blob, "uiii")[1])
                yield pa.RecordBatch.from_arrays([pa.array(doc[doc < since])], ["sid"])

    return run


def drop_repeats(docs: DataFrame, min_len: int = 100) -> DataFrame:
    """The documents with repeated passages taken out of their texts; those left blank are dropped. Columns unchanged.

    Rows without a doc_id and rows that share one are told apart by a key of their own: each is cleaned and keeps its columns.
    """
    key, gone, kept = (fresh(docs, x) for x in ("sid", "n_removed", "kept_text"))
    rows = _with_sid(docs, key)
    base = rows.select(F.col(key).alias("sid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = _cleaned(base, min_len, with_text=True).select(F.col("sid").alias(key), F.col("n_removed").alias(gone), F.col("kept_text").alias(kept))
    joined = rows.drop("text").join(got, key).where((F.col(gone) == 0) | (F.trim(kept) != ""))
    return joined.withColumn("text", F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
