"""Document likelihood under a subword lattice model.

The pieces come from an existing subword vocabulary. Its own scores give the first weights; the one at hand is a byte-pair
vocabulary, whose scores are ranks, so they are read as Zipf weights. The weights then learn by expectation maximisation
over all segmentations, with the first weights as a prior: a few rounds over the commonest words, then one over the word
counts of all training documents (the sums are gathered by piece, so the driver holds one number a piece). A word's
lattice probability is the sum over all its segmentations, by forward recursion in log space; every character can also
be spelt by its bytes, so nothing is unknown.

``score`` is the lattice's marginal: the product over a text's words and its end mark. ``mixed_score`` is an extra: there
words met in training have one arc more, over the whole word, with their discounted share of the training tokens; the
discounted mass weighs the segmentations, and texts are mixed over the languages of the training rows.

``base_score`` is the word-unigram score of the contract. The counts of the ``top_words`` most frequent
words go to every task (a fixed number of words, however large the corpus); all other words are looked up
by a join with the whole count table, so no word is left out.

Edge cases: null and empty texts are the end mark alone; very long words and texts are scored whole; rows
are kept one to one, repeated doc_ids included; with no training rows c = N = V = 0 and the first weights
stand; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, lean, materialise, small_batches
from covelake.llm.kernels import Prefix, mix
from covelake.llm.training import fold

LOG10 = math.log(10)
CACHE_WORDS = 150_000
#: Groups of training rows (languages); rarer languages share the first.
GROUPS = 9
MARK = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str | tuple) -> tuple[list[str], list[int], np.ndarray]:
    """(pieces, ids of the 256 bytes, first log weights) of a model file, or given as such; the last id is the end mark."""
    if isinstance(path, tuple):
        return path
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, weight, byte_ids = [], np.zeros(n + 1), [0] * 256
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:-1], 16)] = i
            pieces.append("")
            weight[i] = 1 / n
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            pieces.append("")
        else:
            pieces.append(p)
            weight[i] = 1 / (2 - min(sp.get_score(i), 0))  # a rank becomes a Zipf weight
    pieces.append("")
    weight[n] = weight.max()
    with np.errstate(divide="ignore"):
        return pieces, byte_ids, np.log(weight / weight.sum())


class Lattice:
    """All segmentations of many words at once. Positions are characters; arcs are pieces and byte spellings."""

    def __init__(self, pieces: list[str], byte_ids: list[int], logp: np.ndarray):
        self.logp, self.bytes, self.end = logp, np.array(byte_ids), float(logp[-1])
        ids = np.array([i for i, p in enumerate(pieces) if p])
        begins = sorted({pieces[i][:k] for i in ids for k in range(1, len(pieces[i]) + 1)})
        h = self._hash(begins)
        self.seen = np.zeros(1 << 22, bool)  # of what some piece begins with
        self.seen[h >> np.uint64(42)] = True
        h = self._hash([pieces[i] for i in ids])
        order = np.argsort(h)
        self.hashes, self.ids = h[order], ids[order]
        self.first = np.searchsorted(self.hashes, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.most = int(np.bincount((h >> np.uint64(44)).astype(np.int64)).max())
        self.longest = max(len(pieces[i]) for i in ids)
        self.cache: dict[bytes, float] = {}

    @staticmethod
    def _hash(texts: list[str]) -> np.ndarray:
        data = [t.encode("utf-8") for t in texts]
        off = np.concatenate([[0], np.cumsum([len(t) for t in data])])
        return mix(Prefix(np.frombuffer(b"".join(data), np.uint8)).range(off[:-1], off[1:]))

    def arcs(self, words: list[bytes]):
        """(start, end, piece ids or -1, log weight) of all arcs in order of end, nodes' (depth, word, first node of a word)."""
        mark = MARK.encode("utf-8")
        data = np.frombuffer(b"".join([mark + w for w in words]), np.uint8)
        ends = np.cumsum([len(w) + len(mark) for w in words])
        at = np.flatnonzero((data & 0xC0) != 0x80)
        word = np.searchsorted(ends, at, side="right")
        chars = np.bincount(word, minlength=len(words))
        pos = np.append(at, len(data))
        depth = np.arange(len(at)) - np.repeat(np.cumsum(chars) - chars, chars)
        # node of a character: its index + its word's number, so that every word has one node more than characters
        node = np.arange(len(at)) + word
        prefix = Prefix(data)
        cost = np.concatenate([[0.0], np.cumsum(self.logp[self.bytes[data]])])
        out = [(node, node + 1, np.full(len(at), -1), cost[pos[1:]] - cost[pos[:-1]])]
        left = chars[word] - depth
        live = np.arange(len(at))
        for size in range(1, self.longest + 1):
            live = live[left[live] >= size]
            h = mix(prefix.range(pos[live], pos[live + size]))
            some = self.seen[h >> np.uint64(42)]
            live, h = live[some], h[some]  # others begin no piece, nor longer ones
            if not len(live):
                break
            k = self.first[h >> np.uint64(44)]
            piece = np.full(len(h), -1)
            for step in range(self.most):
                at_k = np.minimum(k + step, len(self.hashes) - 1)
                piece = np.where(self.hashes[at_k] == h, self.ids[at_k], piece)
            hit = np.flatnonzero(piece >= 0)
            who, piece = live[hit], piece[hit]
            out.append((node[who], node[who] + size, piece, self.logp[piece]))
        start, end, piece, w = (np.concatenate(x) for x in zip(*out, strict=True))
        first = np.cumsum(chars + 1) - chars - 1
        rank = np.arange(int((chars + 1).sum())) - np.repeat(first, chars + 1)
        return start, end, piece, w, rank, first, chars, data, pos

    @staticmethod
    def _sweep(value, frm, to, w, level):
        """value[to] = log-sum of value[frm] + w, level by level of ``level`` (the depth of ``to``)."""
        order = np.lexsort((to, level))
        frm, to, w, level = frm[order], to[order], w[order], level[order]
        cut = np.searchsorted(level, np.arange(level[-1] + 2)) if len(level) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a < b:
                v, t = value[frm[a:b]] + w[a:b], to[a:b]
                head = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                top = np.maximum.reduceat(v, head)
                size = np.diff(np.append(head, b - a))
                value[t[head]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, size)), head))

    def _forward(self, words):
        start, end, piece, w, rank, first, chars, data, pos = self.arcs(words)
        alpha = np.zeros(len(rank))
        self._sweep(alpha, start, end, w, rank[end])
        return alpha, start, end, piece, w, rank, first, chars, data, pos

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        alpha, *_, first, chars, _, _ = self._forward(words)
        return alpha[first + chars]

    def lookup(self, words: set[bytes]) -> dict[bytes, float]:
        """Log probabilities of all the words; those not met before are computed together."""
        got = {w: p for w in words if (p := self.cache.get(w)) is not None}
        new = list(words - got.keys())
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            found = dict(zip(part, self.log_probs(part).tolist(), strict=True))
            got |= found
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            self.cache.update(found)
        return got

    def expect(self, words: list[bytes], weight: np.ndarray) -> np.ndarray:
        """Expected piece counts of the words, each ``weight`` times."""
        alpha, start, end, piece, w, rank, first, chars, data, pos = self._forward(words)
        beta = np.zeros(len(rank))
        self._sweep(beta, end, start, w, chars.max() - rank[start])
        owner = np.repeat(np.arange(len(words)), chars + 1)[start]
        share = np.exp(alpha[start] + w + beta[end] - alpha[first + chars][owner]) * weight[owner]
        out = np.bincount(piece[piece >= 0], weights=share[piece >= 0], minlength=len(self.logp))
        spelt = piece < 0  # these stand first, one a character in order
        out += np.bincount(self.bytes[data], weights=np.repeat(share[spelt], np.diff(pos)), minlength=len(self.logp))
        return out


def _words_of(batch: pa.RecordBatch, name: str = "text"):
    data, off = binary_column(batch, name)
    for a, b in zip(off[:-1], off[1:], strict=True):
        yield data[a:b].tobytes().lower().split()  # ASCII case and blanks


def word_counts(docs: DataFrame, flush: int = 200_000) -> DataFrame:
    """(word binary, group int, n): counted in each task, then summed. ``docs``: text, group."""

    def rows(seen):
        keys = list(seen)
        for i in range(0, len(keys), 20_000):
            part = keys[i : i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in part], pa.binary()), pa.array([k[1] for k in part], pa.int32()), pa.array([seen[k] for k in part], pa.int64())], ["word", "group", "n"])

    def run(batches):
        seen: dict[int, Counter] = defaultdict(Counter)
        for batch in batches:
            groups = batch.column(batch.schema.get_field_index("group")).to_pylist()
            for g, words in zip(groups, _words_of(batch), strict=True):
                seen[g].update(words)
                if len(seen[g]) > flush:
                    yield from rows({(w, g): n for w, n in seen.pop(g).items()})
        for g, own in seen.items():
            yield from rows({(w, g): n for w, n in own.items()})

    return docs.select("text", "group").mapInArrow(lean(run), "word binary, group int, n long").groupBy("word", "group").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, ends: int, path: str | tuple, common: tuple[list[bytes], np.ndarray], warm: int = 3, rounds: int = 1, prior: float = 50.0) -> np.ndarray:
    """Log weights of the pieces: ``warm`` rounds of expectation maximisation over the ``common`` words only, then ``rounds`` over all of ``counts``."""
    logp = vocabulary(path)[2]
    first = np.exp(logp)

    def weights(sums: np.ndarray) -> np.ndarray:
        total = first * prior + sums
        total[-1] += ends
        with np.errstate(divide="ignore"):
            return np.log(total / total.sum())

    words, n = common
    for _ in range(warm if words else 0):
        lattice = Lattice(*vocabulary(path)[:2], logp)
        logp = weights(sum(lattice.expect(words[i : i + 20_000], n[i : i + 20_000]) for i in range(0, len(words), 20_000)))
    for _ in range(rounds):

        def run(batches, logp=logp):
            lattice = Lattice(*vocabulary(path)[:2], logp)
            into = np.zeros(len(logp))
            for batch in batches:
                words, n = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), np.float64)
                for i in range(0, len(words), 20_000):
                    into += lattice.expect(words[i : i + 20_000], n[i : i + 20_000])
            hit = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(into[hit])], ["piece", "n"])

        got = counts.select("word", "n").mapInArrow(lean(run), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # one row a piece
        sums = np.zeros(len(logp))
        for r in got:
            sums[r.piece] = r.n
        logp = weights(sums)
    return logp


_LOADED: dict = {}


def _loaded(model_id: str, shared, path: str):
    """The worker's copy of the model: kept from task to task with the words it has met."""
    if model_id not in _LOADED:
        _LOADED.clear()
        words, table, logp = shared.value
        _LOADED[model_id] = ({w: i for i, w in enumerate(words.split(b" ") if words else [])}, table, Lattice(*vocabulary(path)[:2], logp))
    return _LOADED[model_id]


def lm_scores(docs: DataFrame, modulus: int = 5, held: int = 1, vocabulary_path: str | tuple | None = None, top_words: int = 100_000, warm_words: int = 50_000, discount: float = 0.6) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score of every row of ``docs``.

    For ``mixed_score`` the training rows' ``lang`` (if there is one) splits the counts into at most ``GROUPS`` groups; a
    text's probability is the mixture over the groups, so its own lang is never looked at.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    path = vocabulary_path or default_path()
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce(fold("doc_id", modulus) == held, F.lit(False)).alias("held_out"), lang.alias("lang"))
    top = [r.lang for r in base.where(~F.col("held_out")).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(GROUPS - 1).collect()]
    group = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in top]), F.col("lang")).cast("int"), F.lit(0)) if top else F.lit(0)  # 0: all other languages
    training = base.where(~F.col("held_out")).select("text", group.cast("int").alias("group"))
    wide = [F.coalesce(F.sum(F.when(F.col("group") == g, F.col("n"))), F.lit(0)).cast("long").alias(f"n{g}") for g in range(GROUPS)]
    counts = materialise(word_counts(training).groupBy("word").agg(F.sum("n").alias("n"), *wide), "words")
    ends_by = np.zeros(GROUPS)
    for r in training.groupBy("group").count().collect():
        ends_by[r["group"]] = r["count"]
    sums = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(f"n{g}"), F.lit(0)) for g in range(GROUPS)], *[F.coalesce(F.sum((F.col(f"n{g}") > 0).cast("long")), F.lit(0)) for g in range(GROUPS)]).first()
    kinds, words_by, kinds_by = sums[0], np.array(sums[1 : 1 + GROUPS], float), np.array(sums[1 + GROUPS :], float)
    ends = int(ends_by.sum())
    total, distinct = int(words_by.sum()) + ends, kinds + (ends > 0)
    log_z = math.log10(total + 0.5 * (distinct + 1))
    best = counts.orderBy(F.desc("n"), "word").limit(top_words).toArrow()  # a fixed number of words
    common = best.column("word").to_pylist()
    logp = fit(counts, ends, path, (common[:warm_words], best.column("n").to_numpy()[:warm_words].astype(float)))
    # In a group a word has its discounted share of the tokens, and the words share what was discounted by their lattice probability.
    tokens_by = words_by + ends_by
    live = np.flatnonzero(ends_by > 0).tolist() or [0]
    n_by = np.where(tokens_by > 0, tokens_by, 1.0)
    back = np.where(tokens_by > 0, discount * kinds_by / n_by, 1.0 - 1e-9)
    back = np.where((tokens_by > 0) & (kinds_by == 0), 1e-9, back)
    end_group = np.where(tokens_by > 0, ends_by / n_by, math.exp(logp[-1]))
    share = np.where(ends_by > 0, ends_by, 0.0) / ends if ends else np.eye(GROUPS)[0]
    end_base = math.log10(ends + 0.5) - log_z
    end_log = np.log10(np.maximum(end_group, 1e-300))
    # Base score, a score in each live group and the lattice's of the common words; the last row stands for all others.
    table = np.zeros((len(common) + 1, 2 + len(live)))
    if common:
        lattice = Lattice(*vocabulary(path)[:2], logp)
        lat = np.concatenate([lattice.log_probs(common[i : i + 20_000]) for i in range(0, len(common), 20_000)])
        table[:-1, 0] = np.log10(best.column("n").to_numpy() + 0.5) - log_z
        table[:-1, -1] = lat / LOG10
        for k, g in enumerate(live):
            own = np.maximum(best.column(f"n{g}").to_numpy() - discount, 0) / n_by[g]
            table[:-1, 1 + k] = np.where(own > 0, np.log10(np.where(own > 0, own, 1) + back[g] * np.exp(lat)), lat / LOG10 + np.log10(back[g]))
    shared = spark.sparkContext.broadcast((b" ".join(common), table, logp))  # words hold no blanks
    model_id = uuid.uuid4().hex

    def run(batches):
        index, table, lattice = _loaded(model_id, shared, path)
        logp = lattice.logp
        other = len(index)
        get = index.get
        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            docs_seen = [Counter(words) for words in _words_of(batch)]
            lat = lattice.lookup({w for seen in docs_seen for w in seen if w not in index})
            main: list[list] = [[], [], [], []]
            words: list[bytes] = []
            counts: list[np.ndarray] = []
            sizes: list[int] = []
            for seen in docs_seen:
                keys = list(seen)
                at = np.fromiter(map(get, keys, repeat(other)), np.int64, len(keys))
                n = np.fromiter(seen.values(), np.float64, len(keys))
                sums = n @ table[at] if keys else np.zeros(2 + len(live))
                miss = np.flatnonzero(at == other)
                new = list(map(keys.__getitem__, miss.tolist()))
                words += new
                counts.append(n[miss])
                sizes.append(len(new))
                spelt = sums[-1] + logp[-1] / LOG10 + float(n[miss] @ np.fromiter(map(lat.__getitem__, new), np.float64, len(new))) / LOG10
                main[1].append(int(n.sum()) + 1)
                main[2].append(int(n.sum() - n[miss].sum()) + int(ends > 0))
                main[3].append([end_base + sums[0], *(end_log[g] + sums[1 + k] for k, g in enumerate(live)), spelt])
            rids = np.arange(rid, rid + len(docs_seen))
            rid += len(docs_seen)
            m, r = len(docs_seen), len(words)
            vector = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids), batch.column(0), batch.column(2), pa.array(main[1], pa.int64()), pa.array(main[2], pa.int64()), pa.array(main[3], vector), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64())],
                names := ["rid", "doc_id", "held_out", "n_tokens", "n_known", "sums", "word", "times", "lat"],
            )
            if r:
                spelling = np.fromiter(map(lat.__getitem__, words), np.float64, r) / LOG10
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rids, sizes)), pa.nulls(r, pa.int64()), pa.nulls(r, pa.bool_()), pa.nulls(r, pa.int64()), pa.nulls(r, pa.int64()), pa.nulls(r, vector), pa.array(words, pa.binary()), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(spelling)], names)

    rows = materialise(base.select("doc_id", "text", "held_out").mapInArrow(lean(run), "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, sums array<double>, word binary, times long, lat double"), "scored")
    rare = rows.where("word is not null").select("rid", "word", "times", "lat").join(counts, "word", "left")
    times, zero = F.col("times"), F.lit(0)
    terms = [F.sum(times * (F.log10(F.coalesce("n", zero) + 0.5) - F.lit(log_z))).alias("s0")]
    for k, g in enumerate(live):
        own = F.greatest(F.coalesce(f"n{g}", zero) - F.lit(discount), F.lit(0.0)) / F.lit(float(n_by[g]))
        # a very long word's lattice probability may be below the smallest double: where it stands alone, its logarithm does
        both = F.log10(own + F.lit(float(back[g])) * F.pow(F.lit(10.0), "lat"))
        terms.append(F.sum(times * F.when(own > 0, both).otherwise(F.col("lat") + F.lit(float(np.log10(back[g]))))).alias(f"s{1 + k}"))
    found = rare.groupBy("rid").agg(*terms, F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("known"))
    main = rows.where("word is null").drop("word", "times", "lat").join(found, "rid", "left")
    part = [F.element_at("sums", 1 + k) + F.coalesce(f"s{k}", F.lit(0.0)) for k in range(1 + len(live))]
    weighted = F.array(*[part[1 + k] + F.lit(float(np.log10(share[g]))) for k, g in enumerate(live)])
    best = F.array_max("weighted")
    main = main.withColumn("weighted", weighted)
    mixed = best + F.log10(F.aggregate("weighted", F.lit(0.0), lambda acc, x: acc + F.pow(F.lit(10.0), x - best)))
    score = F.element_at("sums", 2 + len(live))
    return main.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), part[0].alias("base_score"), score.alias("score"), mixed.alias("mixed_score"))
