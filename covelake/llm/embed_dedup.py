"""Near-duplicate vectors by product quantisation.

Identical vectors form a class; classes are indexed in two levels. A bounded sample (``sample`` vectors) trains the
centroids of the upper cells, about ``CELL`` classes each, and, on residuals, one codebook for each of ``SUBSPACES``
subspaces. Each class goes to the cell of its nearest centroid; in a cell, blocks of at most ``CELL`` members have inverted
lists of about ``LIST`` members each, around centroids of their own. So lists grow in number with the rows, not in length.
A member is kept as one code a subspace, for its residual in its list, and its exact quantisation error.

A vector is looked up in the ``PROBE_CELLS`` nearest cells and there in the ``PROBE_LISTS`` nearest lists of each block: a
fixed number of members whatever the table's size. Where near copies are so many that they fill lists and cells of their
own, it also looks into every one whose centroid is within the radius of a link: those hold its links, which count one by
one. A pair of vectors meets if either of them probes the other's list. Of
what is probed, asymmetric table-lookup distances to the codes drop what is farther than the radius of the asked
cosine plus its quantisation error (nothing within it is lost), and the rest is decided by the exact cosine in double
precision. What the fixed probes miss is the only loss; the README gives the measured recall.

Every pair is judged at one place, and counts for both: two members of a cell in the block of the lower of their
(block, rep); members of different cells in the cell that is probed, and if each probes the other's, in the lower
one. Pairs are never written out: tasks return links per class and a spanning forest of the links found. Cells longer than
a block, and queries above ``QUERIES``, are cut by hash.

Edge cases: vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows without a
vec_id; vectors of different lengths never link; repeated vec_ids give a row each; extra columns are ignored, whatever their
names; empty tables yield no rows. Columns of floats stay floats until they are compared; all others are taken as doubles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from covelake.llm.common import components, lean, materialise

SUBSPACES, CODES = 8, 256
#: Members of a cell's block, of a list, queries that a task takes, centroids of cells at most, and what is probed.
CELL, LIST, QUERIES, MOST_CELLS = 2048, 64, 16_384, 16_384
PROBE_CELLS, PROBE_LISTS = 6, 8


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    k = min(k, len(x))
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centre[n > 0] = total[n > 0] / n[n > 0, None]
    return centre


def _sq(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None], 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_sq(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _probes(x: np.ndarray, c: np.ndarray, k: int, r: float) -> np.ndarray:
    """Which of ``c`` each row probes: the ``k`` nearest, and all within ``r``."""
    out = np.zeros((len(x), len(c)), bool)
    for i in range(0, len(x), 1024):
        d = _sq(x[i : i + 1024], c)
        out[i : i + 1024] = d <= r * r
        if k < len(c):
            np.put_along_axis(out[i : i + 1024], np.argpartition(d, k - 1, axis=1)[:, :k], True, 1)
        else:
            out[i : i + 1024] = True
    return out


class Index:
    """Centroids of cells and codebooks, from a sample of ``count`` vectors."""

    def __init__(self, sample: np.ndarray, count: int, cosine: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.cosine, self.r = cosine, math.sqrt(2 - 2 * cosine)
        self.cells = _kmeans(sample, min(MOST_CELLS, -(-count // CELL)), 6, rng)
        self.parts = [p for p in np.array_split(np.arange(dim), min(SUBSPACES, dim)) if len(p)]
        lists = _kmeans(sample, max(1, len(sample) // LIST), 3, rng)
        rest = sample - lists[_nearest(sample, lists)]
        self.books = [_kmeans(rest[:, p], CODES, 5, rng) for p in self.parts]

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, what they stand for) of residuals."""
        codes = np.stack([_nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], 1)
        return codes, np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], 1)


class Block:
    """Inverted lists of a block of members, which must come in one order."""

    def __init__(self, index: Index, x: np.ndarray):
        self.index, self.x = index, x
        rng = np.random.default_rng(len(x))
        self.centre = _kmeans(x, max(1, len(x) // LIST), 3, rng)
        self.own = _nearest(x, self.centre)
        self.codes, back = index.encode(x - self.centre[self.own])
        back += self.centre[self.own]
        self.norm, self.error = (back * back).sum(1), np.sqrt(((x - back) ** 2).sum(1))
        self.probes = _probes(x, self.centre, PROBE_LISTS, index.r)

    def candidates(self, q: np.ndarray):
        """(queries, members) that meet in a list and whose table-lookup distance leaves a link possible."""
        look, near = _probes(q, self.centre, PROBE_LISTS, self.index.r), _nearest(q, self.centre)
        tables = [q[:, p] @ b.T for p, b in zip(self.index.parts, self.index.books, strict=True)]
        size, centred = (q * q).sum(1), q @ self.centre.T
        limit = (self.index.r + self.error) ** 2 + 1e-9
        for k in range(len(self.centre)):
            # members of the list for queries that probe it, and members that probe the list for queries that belong there
            for asks, has in ((look[:, k], self.own == k), (near == k, self.probes[:, k])):
                a, m = np.flatnonzero(asks), np.flatnonzero(has)
                if not len(a) or not len(m):
                    continue
                dot = centred[a[:, None], self.own[m]]
                for t, table in enumerate(tables):
                    dot += table[a[:, None], self.codes[m, t]]
                i, j = np.nonzero(size[a][:, None] - 2 * dot + self.norm[m][None] <= limit[m][None])
                yield a[i], m[j]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    scale = np.abs(x).max(1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray):
    """Spanning forest of the edges (a, b)."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            yield x, y


def _scan(index: Index, dim: int):
    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        block = table.column("mb")[0].as_py()
        order = np.lexsort((table.column("rep").to_numpy(), ~table.column("member").to_numpy()))
        table = table.take(pa.array(order))
        member = table.column("member").to_numpy()
        rep, n, own, qmb = (table.column(c).to_numpy() for c in ("rep", "n", "own", "own_mb"))
        x = _matrix(table.column("v").combine_chunks(), dim)
        size = int(member.sum())
        links = np.zeros(len(rep), np.int64)
        pairs = [np.zeros((2, 0), np.int64)]
        if size and size < len(rep):
            lists = Block(index, x[:size])
            back = _probes(x[:size], index.cells, PROBE_CELLS, index.r)  # cells that a member looks into itself
            for i in range(size, len(rep), 2048):
                q = np.arange(i, min(i + 2048, len(rep)))
                met = [np.zeros((2, 0), np.int64), *(np.stack([q[a], b]) for a, b in lists.candidates(x[q]))]
                a, b = np.concatenate(met, 1)
                here = own[a] == cell
                mine = np.where(here, (qmb[a] > block) | (qmb[a] == block) & (rep[a] > rep[b]), ~back[b, own[a]] | (cell < own[a]))
                key = np.unique(a[mine] * np.int64(size) + b[mine])  # both ways of meeting count once
                a, b = key // size, key % size
                near = np.concatenate([np.einsum("ij,ij->i", x[a[c : c + 65536]], x[b[c : c + 65536]]) >= index.cosine for c in range(0, len(a), 65536)] or [np.zeros(0, bool)])
                a, b = a[near], b[near]
                links += np.bincount(a, weights=n[b], minlength=len(rep)).astype(np.int64) + np.bincount(b, weights=n[a], minlength=len(rep)).astype(np.int64)
                pairs.append(np.array([*_forest(rep[a], rep[b])], np.int64).reshape(-1, 2).T)
        both = np.concatenate(pairs, 1)
        edge = np.array([*_forest(both[0], both[1])], np.int64).reshape(-1, 2)
        got = np.flatnonzero(links)
        return pa.table({"a": pa.array(np.concatenate([rep[got], edge[:, 0]]), pa.int64()), "b": pa.array([None] * len(got) + edge[:, 1].tolist(), pa.int64()), "n": pa.array(links[got].tolist() + [None] * len(edge), pa.int64())})

    return run


def _links_of(classes: DataFrame, dim: int, count: int, cosine: float, sample: int) -> DataFrame:
    """(a, null, links of class a) and (a, b, null) edges among classes (rep, n, v) of one length."""
    rows = classes.select("rep", "v").orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toArrow()  # bounded
    index = Index(_matrix(rows.column(0).combine_chunks(), dim), count, cosine)
    kind = classes.schema["v"].dataType.simpleString()

    def assign(batches):
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(2), dim)
                look = _probes(x, index.cells, PROBE_CELLS, index.r)
                flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(look.sum(1))]), pa.int32()), pa.array(np.nonzero(look)[1], pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_nearest(x, index.cells), pa.int32()), flat], ["rep", "n", "v", "own", "probes"])

    put = materialise(classes.select("rep", "n", "v").mapInArrow(lean(assign), f"rep long, n long, v {kind}, own int, probes array<int>"), "cells")
    members, asking = [0] * len(index.cells), [0] * len(index.cells)  # one number a cell
    for r in put.groupBy("own").count().collect():
        members[r.own] = r["count"]
    for r in put.select(F.explode("probes").alias("p")).groupBy("p").count().collect():
        asking[r.p] = r["count"]
    cut = lambda sizes, each, cell: F.element_at(F.array(*[F.lit(max(1, -(-k // each))) for k in sizes]), cell + 1)
    hashed = F.xxhash64("rep")
    put = put.withColumn("own_mb", F.pmod(hashed, cut(members, CELL, F.col("own"))).cast("int"))
    qbs, mbs = cut(asking, QUERIES, F.col("cell")), cut(members, CELL, F.col("cell"))
    told = put.withColumn("cell", F.col("own")).select(F.lit(True).alias("member"), "rep", "n", "v", "own", "own_mb", "cell", F.col("own_mb").alias("mb"), F.explode(F.sequence(F.lit(0), qbs - 1)).alias("qb"))
    asks = put.withColumn("cell", F.explode("probes"))
    # a query of the cell itself is judged in blocks up to its own
    last = F.when(F.col("cell") == F.col("own"), F.col("own_mb")).otherwise(mbs - 1)
    asks = asks.select(F.lit(False).alias("member"), "rep", "n", "v", "own", "own_mb", "cell", F.explode(F.sequence(F.lit(0), last)).alias("mb"), F.pmod(hashed, qbs).cast("int").alias("qb"))
    return told.unionByName(asks).groupBy("cell", "mb", "qb").applyInArrow(_scan(index, dim), "a long, b long, n long")


def near_vectors(vectors: DataFrame, cosine: float = 0.9, sample: int = 20_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    kept = vectors.schema[vector_col].dataType
    kind = "array<float>" if isinstance(kept, ArrayType) and isinstance(kept.elementType, FloatType) else "array<double>"
    v = F.col("v")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    sound = F.coalesce(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    base = base.withColumn("sound", sound).withColumn("k1", F.when(F.col("sound"), F.xxhash64(v))).withColumn("k2", F.when(F.col("sound"), F.xxhash64(F.lit(1), v)))
    classes = materialise(base.where("sound").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")), "classes")
    found = None
    for r in classes.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect():  # one row a vector length
        own = _links_of(classes.where(F.size("v") == r.dim), r.dim, r["count"], cosine, sample)
        found = own if found is None else found.union(own)
    if found is None:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialise(found, "links")
    comp = components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    info = classes.select("k1", "k2", "rep", "n").join(comp, F.col("rep") == comp["node"], "left").join(links, F.col("rep") == links["a"], "left")
    info = materialise(info.select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "classes")
    good = base.where("sound").select("vec_id", "k1", "k2").join(info, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = base.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT v.vec_id, (SELECT count(*) FROM link l WHERE l.a = v.vec_id) AS n_links, min(r.other) AS component_id, v.vec_id = min(r.other) AS kept
FROM v JOIN reach r USING (vec_id) GROUP BY v.vec_id
"""
