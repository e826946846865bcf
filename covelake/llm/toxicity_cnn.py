"""Toxicity from a small convolutional text classifier, trained in numpy.

Lower-cased words are hashed into an embedding table, each by itself and by its first 4 and 6 bytes, so that
inflected forms share their stem; a word's vector is the sum of the three. The first coordinate of a bucket
starts at its log-odds in the training rows. Filters of widths 1, 2 and 3 run over the whole text, each is max-pooled
over all positions, and a logistic layer follows. Training uses a bounded sample (``max_docs`` rows,
``max_bytes`` bytes); a quarter of it is set aside to calibrate the score to the true share of label 1
(Platt scaling) and one decision threshold per language.

``score`` depends on the text alone; ``predicted`` is score >= 0.5. ``threshold`` and ``flagged`` apply
the language's own threshold (0.5 where the language was not in the sample or there is no lang column).

Edge cases: null, empty and word-less texts are one padding word; long texts are processed whole;
repeated doc_ids give a row each; without both labels every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, lean, small_batches, text_slices
from covelake.llm.kernels import LOWER, NOT_WORD, Prefix, mix, spans
from covelake.llm.training import fold, labelled_sample, platt, sigmoid

BUCKETS, DIM, FILTERS, WIDTHS, PARTS = 1 << 16, 8, 8, (1, 2, 3), 3
PAD = len(WIDTHS) - 1
#: Training documents that a bucket must occur in to have a vector, and the smoothing of its log-odds.
MIN_DOCS, SMOOTH = 3, 2.0


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): for all words the buckets of their parts (n, 3), each text followed by padding (bucket 0); no text is without a row."""
    low = LOWER[data]
    start, end, owner = spans(low, offsets, NOT_WORD)
    words = np.bincount(owner, minlength=len(offsets) - 1) if len(owner) else np.zeros(len(offsets) - 1, np.int64)
    size = np.maximum(words, 1) + PAD
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros((int(off[-1]), PARTS), np.int32)
    if len(start):
        prefix = Prefix(low)
        at = np.arange(len(start)) - np.repeat(np.cumsum(words) - words, words) + np.repeat(off[:-1], words)
        for k, longest in enumerate((1 << 62, 4, 6)):
            h = mix(prefix.range(start, np.minimum(end, start + longest) if k else end) + np.uint64(k))
            out[at, k] = (h % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
    return out, off


def pooled(table: np.ndarray, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Max-pooled responses (texts, widths * FILTERS). ``table``: every bucket's response at each offset of each width."""
    keep = np.ones(len(ids), bool)
    for k in range(1, PAD + 1):
        keep[off[1:] - k] = False  # windows start at words, never in the padding
    first = np.flatnonzero(keep)
    starts = np.concatenate([[0], np.cumsum(np.diff(off) - PAD)])[:-1]
    each = table[ids[:, 0]]
    for k in range(1, PARTS):
        each += table[ids[:, k]]
    out, col = [], 0
    for w in WIDTHS:
        conv = each[first, col : col + FILTERS]
        for j in range(1, w):
            conv = conv + each[first + j, col + j * FILTERS : col + (j + 1) * FILTERS]
        out.append(np.maximum.reduceat(conv, starts, axis=0))
        col += w * FILTERS
    return np.concatenate(out, 1)


def _docs(sample):
    at = np.concatenate([[0], np.cumsum([len(t) for t, *_ in sample])]).astype(np.int64)
    out = []
    for i, j in text_slices(at):
        ids, off = word_ids(np.frombuffer(b"".join(t for t, *_ in sample[i:j]), np.uint8), at[i : j + 1] - at[i])
        out += [ids[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
    return out


def train(sample, share: float, epochs: int = 6, seed: int = 3) -> dict | None:
    """``share``: the share of label 1 among all training labels, to which the score is calibrated."""
    y = np.array([s[1] for s in sample], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    docs = _docs(sample)
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for v in (0, 1):
        at = np.flatnonzero(y == v)
        held[at[3::4]] = True
    fit = np.flatnonzero(~held)
    seen = np.zeros((2, BUCKETS))
    for i in fit:
        seen[int(y[i]), np.unique(docs[i])] += 1
    # words of few training documents say nothing yet: they share the zero vector, now and when scoring
    known = seen.sum(0) >= MIN_DOCS
    known[0] = False
    odds = np.log((seen[1] + SMOOTH) / (y[fit].sum() + 2 * SMOOTH)) - np.log((seen[0] + SMOOTH) / ((1 - y[fit]).sum() + 2 * SMOOTH))
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)) * known[:, None]
    emb[:, 0] = np.clip(odds, -4, 4) * 0.4 * known
    params = {"emb": emb, "out": rng.normal(0.3, 0.1, len(WIDTHS) * FILTERS), "bias": np.zeros(1)}
    for w in WIDTHS:
        params[f"k{w}"] = rng.normal(0, 0.3, (w * DIM, FILTERS))
        params[f"k{w}"][0::DIM, : FILTERS // 2] += 0.7  # half of the filters begin as detectors of loaded words
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    t = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
            g = {k: np.zeros_like(v) for k, v in params.items()}
            for i in part:
                ids = docs[i]
                n = len(ids) - PAD
                e = params["emb"][ids].sum(1)
                hidden, where = [], []
                for w in WIDTHS:
                    conv = np.lib.stride_tricks.sliding_window_view(e[: n + w - 1].ravel(), w * DIM)[::DIM] @ params[f"k{w}"]
                    at = conv.argmax(0)
                    where.append(at)
                    hidden.append(conv[at, np.arange(FILTERS)])
                h = np.concatenate(hidden)
                act = np.maximum(h, 0)
                d = sigmoid(act @ params["out"] + params["bias"][0]) - y[i]
                g["out"] += d * act
                g["bias"] += d
                dh = d * params["out"] * (h > 0)
                for b, w in enumerate(WIDTHS):
                    for f in np.flatnonzero(dh[b * FILTERS : (b + 1) * FILTERS]):
                        at, s = where[b][f], dh[b * FILTERS + f]
                        g[f"k{w}"][:, f] += s * e[at : at + w].ravel()
                        np.add.at(g["emb"], ids[at : at + w], (s * params[f"k{w}"][:, f].reshape(w, 1, DIM)))
            t += 1
            for k, v in params.items():
                m, s = adam[k]
                grad = g[k] / len(part) + (1e-4 * v if k != "emb" else 0)
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                v -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
            params["emb"][~known] = 0
    model = {"table": np.concatenate([params["emb"] @ params[f"k{w}"][j * DIM : (j + 1) * DIM] for w in WIDTHS for j in range(w)], 1).astype(np.float32), "out": params["out"], "bias": float(params["bias"][0])}
    z = np.array([float(_logit(model, docs[i], np.array([0, len(docs[i])]))[0]) for i in np.flatnonzero(held)])
    yh = y[held]
    a, b = platt(z, yh)
    share = min(max(share, 1e-4), 1 - 1e-4)
    model["a"], model["b"] = a, b + np.log(share / (1 - share)) - np.log(max(yh.mean(), 1e-4) / max(1 - yh.mean(), 1e-4))
    p = sigmoid(model["a"] * z + model["b"])
    langs = np.array([s[2] or "" for s in sample])[held]
    model["thresholds"] = {lang: _threshold(p[langs == lang], yh[langs == lang]) for lang in sorted(set(langs.tolist())) if lang}
    return model


def _threshold(p, y) -> float:
    """The middle of the cuts with the fewest errors, nearest to 0.5; 0.5 with a missing class."""
    if not len(y) or y.min() == y.max():
        return 0.5
    cuts = np.linspace(0.02, 0.98, 97)
    wrong = np.array([((p >= c) != (y == 1)).mean() for c in cuts])
    best = cuts[wrong <= wrong.min() + 1e-12]
    return float(best[np.abs(best - 0.5).argmin()])


def _logit(model, ids, off):
    return np.maximum(pooled(model["table"], ids, off), 0) @ model["out"] + model["bias"]


def score_texts(model: dict | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(offsets) - 1, 0.5)
    out = [sigmoid(model["a"] * _logit(model, *word_ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) + model["b"]) for i, j in text_slices(offsets)]
    return np.concatenate(out) if out else np.zeros(0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_docs: int = 2400, max_bytes: int = 12 << 20, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, threshold, flagged of every row of ``docs``. No shuffle of texts."""
    small_batches(docs.sparkSession)
    rows = fold("doc_id", modulus) != held
    sample = labelled_sample(docs, labels, "toxic", rows, max_docs, max_bytes)
    share = labels.where(rows & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0] or 0.0
    model = train(sample, share)
    cut = (model or {}).get("thresholds", {})
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), "text").withColumn("held_out", F.coalesce(fold("doc_id", modulus) == held, F.lit(False)))

    def run(batches):
        for batch in batches:
            s = score_texts(model, *binary_column(batch, "text"))
            limit = np.array([cut.get(x or "", 0.5) for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(limit, pa.float64()), pa.array(s >= limit)], ["doc_id", "held_out", "score", "predicted", "threshold", "flagged"])

    return base.mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int, threshold double, flagged boolean")
