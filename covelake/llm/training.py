"""Bounded, documented samples of labelled rows for the small models trained on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train_rows, max_docs: int, max_bytes: int, seed: int = 1) -> list[tuple[bytes, int, str | None]]:
    """At most ``max_docs`` training rows and ``max_bytes`` of text, in hash order, half of each label where there are enough.

    The ids are drawn from ``labels`` (a top-k per label by hash); only the drawn documents' texts
    are read, through a join with that bounded list. Rows without a label or an id are never drawn.
    Returns (text bytes, label, lang or None) in a fixed order.
    """
    each = max_docs // 2
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).where(train_rows)
    drawn = None
    for value in (0, 1):
        part = rows.where(F.col(label) == value).select("doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id", F.lit(seed)).alias("o")).orderBy("o", "doc_id").limit(each)
        drawn = part if drawn is None else drawn.union(part)
    ids = docs.sparkSession.createDataFrame(drawn.collect(), drawn.schema)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select("doc_id", lang.alias("lang"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    got = texts.join(F.broadcast(ids), "doc_id")  # at most max_docs rows
    total, out = 0, []
    sizes = {(r.o, r.doc_id): r.n for r in got.select("o", "doc_id", F.length("text").alias("n")).orderBy("o", "doc_id").limit(2 * max_docs).collect()}
    keep = []
    for key, n in sorted(sizes.items()):
        if total + n <= max_bytes:
            total += n
            keep.append(key[1])
    ids = ids.where(F.col("doc_id").isin(keep)) if len(keep) < len(sizes) else ids
    for r in sorted(texts.join(F.broadcast(ids), "doc_id").collect(), key=lambda r: (r.o, r.doc_id, bytes(r.text))):
        out.append((bytes(r.text), int(r.y), r.lang))
    return out


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """(a, b) of a logistic fit of y on z, with a little shrinkage; neutral where a class is missing."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    m, s = float(z.mean()), float(z.std()) or 1.0
    x = np.stack([(z - m) / s, np.ones(len(z))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / s), float(w[1] - w[0] * m / s)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
