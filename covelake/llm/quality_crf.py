"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is a position of the chain, labelled bad (0) or good (1) from features of
itself and of the lines before and after it. Forward-backward gives each line's marginal; the
length-weighted mean of the marginals is calibrated to the document's probability of label 1.
Training takes documents' labels as the labels of their lines, on a bounded sample
(``max_docs`` rows, ``max_bytes`` bytes), by Adam on the exact conditional likelihood, in numpy.

Edge cases: null and empty texts are one empty line; very long lines and documents are processed
whole (a document's features are a few numbers a line); repeated doc_ids give a row each; without
both labels in the training rows every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, lean, small_batches, text_slices
from covelake.llm.kernels import BLANK, Prefix, spans
from covelake.llm.training import fold, labelled_sample, platt, sigmoid

OWN = 14
WIDTH = 3 * OWN + 3
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARK = ~(_DIGIT | _LETTER | BLANK)
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x2C, 0x3B, 0x3A, 0x3F, 0x21]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line + 1, lines of each document) of concatenated texts; ``offsets`` start at 0."""
    n_docs, size = len(offsets) - 1, len(data)
    nl = np.flatnonzero(data == 0x0A) if size else np.zeros(0, np.int64)
    starts = np.sort(np.concatenate([offsets[:-1], nl + 1]), kind="stable")
    owner = np.sort(np.concatenate([np.arange(n_docs), np.searchsorted(offsets, nl, side="right") - 1]), kind="stable")
    # a line starts at its document's start or after a newline; order by (document, start)
    lines = np.bincount(owner, minlength=n_docs)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    last = np.cumsum(lines) - 1
    ends[last] = offsets[1:]
    length = ends - starts
    count = lambda mask: np.concatenate([[0], np.cumsum(mask)])

    def per(mask):
        c = count(mask[data]) if size else np.zeros(1, np.int64)
        return c[ends] - c[starts]

    ws, we, _ = spans(data, offsets, BLANK)
    lo, hi = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    words = hi - lo
    repeats = np.zeros(len(starts))
    ended = np.zeros(len(starts))
    shout = np.zeros(len(starts))
    alone = np.zeros(len(starts))
    rep_line = np.zeros(len(starts))
    if len(ws):
        h = Prefix(data).range(ws, we)
        line_of = np.searchsorted(starts, ws, side="right") - 1
        # an empty line shares its start with none of the words, so the last line at or before is theirs
        order = np.lexsort((h, line_of))
        same = (h[order][1:] == h[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
        repeats = np.bincount(line_of[order][1:][same], minlength=len(starts)).astype(float)
        tail = _MARK[data[we - 1]] & ~_STOP[data[we - 1]]
        ended = np.bincount(line_of, weights=tail, minlength=len(starts))
        bang = (data[we - 1] == 0x21) & (we - ws > 2) & (data[np.maximum(we - 2, 0)] == 0x21)
        shout = np.bincount(line_of, weights=bang, minlength=len(starts))
        alone = np.bincount(line_of, weights=_MARK[data[ws]] & (we - ws == 1), minlength=len(starts))
        lh = np.add.reduceat(np.append(h * np.uint64(0x9E3779B97F4A7C15), np.uint64(0)), np.minimum(lo, len(h)))
        key = np.where(words > 0, lh, np.uint64(0))
        order = np.lexsort((key, owner))
        same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1]) & (words[order][1:] > 0)
        rep_line[order[1:][same]] = 1
    chars, w = np.maximum(length, 1), np.maximum(words, 1)
    own = np.stack(
        [
            np.log1p(length) / 8, np.log1p(words) / 6, np.minimum(length / w, 20) / 10,
            per(_UPPER) / chars, per(_DIGIT) / chars, per(_MARK) / chars, per(_LETTER) / chars,
            repeats / w, ended / w, shout / w, alone / w, rep_line, (length == 0).astype(float), per(_STOP) / w,
        ], 1,
    )
    first = np.zeros(len(starts), bool)
    first[last - lines + 1] = True
    final = np.zeros(len(starts), bool)
    final[last] = True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[final] = 0, 0
    return np.concatenate([own, before, after, first[:, None], final[:, None], np.ones((len(starts), 1))], 1), length + 1, lines


def _lse(a, axis):
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(unary: np.ndarray, lines: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(line good) for every line of many chains at once, and P(label pair) summed over neighbours (2 x 2).

    ``unary``: (lines, 2) log potentials; chains are contiguous. The chains run side by side, longest first.
    """
    n = len(lines)
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    size = lines[order]
    fwd, bwd = np.empty_like(unary), np.zeros_like(unary)
    longest = int(size[0]) if n else 0
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest)]  # chains longer than t
    for t in range(longest):
        at = start[: live[t]] + t
        fwd[at] = unary[at] + (_lse(fwd[at - 1][:, :, None] + trans[None], 1) if t else 0)
    for t in range(longest - 2, -1, -1):
        at = start[: live[t + 1]] + t
        bwd[at] = _lse((unary[at + 1] + bwd[at + 1])[:, None, :] + trans[None], 2)
    post = fwd + bwd
    z = _lse(post, 1)
    pairs = np.zeros((2, 2))
    has_next = np.ones(len(unary), bool)
    has_next[np.cumsum(lines) - 1] = False
    at = np.flatnonzero(has_next)
    if len(at):
        pairs = np.exp(fwd[at][:, :, None] + trans[None] + (unary[at + 1] + bwd[at + 1])[:, None, :] - z[at][:, None, None]).sum(0)
    return np.exp(post[:, 1] - z), pairs


def _doc_logit(p, weight, lines):
    at = np.cumsum(lines) - lines
    mean = np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at) if len(lines) else np.zeros(0)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def features_of(texts: list[bytes]):
    """line_features of a list, in slices that bound memory."""
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    parts = [line_features(np.frombuffer(b"".join(texts[i:j]), np.uint8), off[i : j + 1] - off[i]) for i, j in text_slices(off)]
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def train(sample: list[tuple[bytes, int, str | None]], rounds: int = 250, decay: float = 1e-4) -> dict | None:
    """Weights of the field and of the calibration, or None without both labels."""
    y = np.array([s[1] for s in sample])
    if not len(y) or y.min() == y.max():
        return None
    x, weight, lines = features_of([s[0] for s in sample])
    mean, scale = x.mean(0), x.std(0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (x - mean) / scale
    label = np.repeat(y, lines)
    at = np.cumsum(lines) - lines
    inner = np.ones(len(x), bool)
    inner[at] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[np.flatnonzero(inner) - 1], label[inner]), 1)
    theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for t in range(1, rounds + 1):
        unary = np.stack([np.zeros(len(x)), x @ theta[:WIDTH]], 1)
        p, pairs = marginals(unary, lines, theta[WIDTH:].reshape(2, 2))
        g = np.concatenate([x.T @ (p - label), (pairs - seen).ravel()]) / len(x) + decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    model = {"w": theta[:WIDTH] / scale, "trans": theta[WIDTH:].reshape(2, 2), "shift": float(-(theta[:WIDTH] * mean / scale).sum())}
    z = _raw(model, x * scale + mean, weight, lines)
    model["a"], model["b"] = platt(z, y)
    return model


def _raw(model, x, weight, lines):
    unary = np.stack([np.zeros(len(x)), x @ model["w"] + model["shift"]], 1)
    p, _ = marginals(unary, lines, model["trans"])
    return _doc_logit(p, weight, lines)


def score_texts(model: dict | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(offsets) - 1, 0.5)
    out = []
    for i, j in text_slices(offsets):
        part = offsets[i : j + 1] - offsets[i]
        out.append(sigmoid(model["a"] * _raw(model, *line_features(data[offsets[i] : offsets[j]], part)) + model["b"]))
    return np.concatenate(out) if out else np.zeros(0)


def quality_scores(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_bytes: int = 12 << 20, modulus: int = 3, held: int = 1, keep_columns: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted (or, with ``keep_columns``, all columns of ``docs`` and the last three)."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", fold("doc_id", modulus) != held, max_docs, max_bytes)
    model = train(sample)
    cols = docs.columns if keep_columns else ["doc_id", "text"]
    base = docs.select(*cols).withColumn("held_out", F.coalesce(fold("doc_id", modulus) == held, F.lit(False)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if keep_columns or f.name != "text") + ", score double, predicted int"

    def run(batches):
        for batch in batches:
            s = score_texts(model, *binary_column(batch, "text"))
            names = [n for n in batch.schema.names if keep_columns or n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    return base.mapInArrow(lean(run), schema)


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the field accepts, columns unchanged."""
    names = {"held_out", "score", "predicted"} & set(docs.columns)
    if names:  # the table's own columns of these names stay out of the way
        inner = docs.select(*[docs[c].alias(f"own_{c}" if c in names else c) for c in docs.columns])
        got = quality_scores(inner, labels, keep_columns=True).where("predicted = 1")
        return got.select(*[got[f"own_{c}" if c in names else c].alias(c) for c in docs.columns])
    return quality_scores(docs, labels, keep_columns=True).where("predicted = 1").select(docs.columns)
