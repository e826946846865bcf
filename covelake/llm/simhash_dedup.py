"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64 bits: each bit is the majority of that bit over the XXH64 (seed 42) of all
shingles of the lower-cased words, repeats included. Documents link at ``max_bits`` = 2 or fewer
differing bits. Two halves of 32 bits: of two fingerprints at distance 2 either the lower halves
are equal or the upper halves differ in at most one bit. So each fingerprint looks up its exact
lower half and the Hamming ball of radius 1 around its upper half (33 keys), and complete distances
decide. Work is on distinct fingerprints, so copies cost one row.

Edge cases: null or blank texts have fingerprint zero and link like any other; texts shorter than a
shingle count as one shingle; repeated doc_ids yield one row each; extra columns are ignored; an
empty table yields no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covelake.llm.common import binary_column, components, lean, materialise, small_batches, text_slices
from covelake.llm.kernels import BLANK, LOWER, Prefix, mix, spans

PART = 1 << 16
#: Bytes of texts whose shingles are made at once.
SLICE = 1 << 18


def fingerprint(text: bytes, shingle: int = 3) -> int:
    import xxhash

    words = text.lower().split()  # ASCII case and ASCII blanks only
    if not words:
        return 0
    norm, n = b" ".join(words), len(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(norm, 42)]
    else:
        size = np.fromiter(map(len, words), np.int64, n)
        end = np.cumsum(size + 1) - 1
        start = (end - size)[: n - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(norm[a:b], 42) for a, b in zip(start, end[shingle - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    h = np.array(hashes, ">u8")
    for i in range(0, len(h), PART):
        ones += np.unpackbits(h[i : i + PART].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; no shuffle."""

    def run(batches):
        for batch in batches:
            data, off = binary_column(batch, "text")
            fp = np.array([fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(off[:-1], off[1:], strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(run), "doc_id long, fp long")


def links(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of representatives whose fingerprints differ in 1 or 2 bits; ``classes``: (rep, fp), fp distinct."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    high = F.shiftrightunsigned("fp", 32)
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    # a key is the half shifted left by one, and the number of the half in the last bit
    ball = F.transform(masks, lambda m: F.shiftleft(high.bitwiseXOR(m), 1))
    exact = F.array(F.shiftleft(low, 1) + F.lit(1).cast("long"))
    ask = classes.select(F.col("rep").alias("a"), F.col("fp").alias("fa"), F.explode(F.concat(ball, exact)).alias("key"))
    table = classes.select(F.col("rep").alias("b"), F.col("fp").alias("fb"), F.explode(F.array(F.shiftleft(high, 1), F.shiftleft(low, 1) + F.lit(1).cast("long"))).alias("key"))
    near = (F.col("fa") < F.col("fb")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= 2)
    return ask.join(table, "key").where(near).select("a", "b").distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, fp (long), component_id (smallest doc_id reachable by links, itself included)."""
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comp = components(links(classes))
    table = classes.join(comp, classes["rep"] == comp["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    table = materialise(table, "groups")
    return fps.join(table, "fp").select("doc_id", "fp", "component_id")


# --- similarity of 0.8 and more ------------------------------------------------------------------------------
# First the operator: distinct texts whose fingerprints are equal or link (``links``) are verified by the similarity of
# their sets of five-word shingles, and groups are formed. Two bits don't reach every pair of 0.8, so an exact way for
# the rest follows, in which only members of different groups meet: by prefix. The distinct five-word shingles of a
# document are put in one order for all documents (those often met in a sample last, then by hash); sets of n shingles
# that share ``least`` of their union share one of their first n - ceil(least * n) + 1, so this way loses no pair,
# however its copies were edited. What meets there is verified in the same way.

#: Sets up to SMALL shingles are sketched by all their hashes, cut to 16 bits; larger ones by one byte for each of BINS bins.
SMALL, BINS = 256, 512
#: Buckets up to PAIRS members compare all pairs at once. Larger ones go in rounds: some members of a bucket meet everyone,
#: then groups are formed, and only members of different groups go on. First LEADERS[0] central members, which share most
#: with others: copies of one text differ least from those that were edited least, so these join nearly all that can be
#: joined. Then up to LEADERS[i] by hash; the last round takes all that is left. No pair is judged again that met before. A
#: pair that no round compares is in one group already, so groups are those of all pairs.
PAIRS, LEADERS = 32, (4, 64, None)
#: Words of 64 bits that hold how often, odd or even, a set's hashes fall on each bit. Two sets differ in at least as many
#: shingles as bits, so in large buckets pairs that differ in too many bits needn't be judged, and no other pair is lost.
PARITY = 4
#: Askers of a large bucket that one task compares with its members.
SHARE = 256
#: Standard errors of a sketch of bins, and chance collisions of a sketch of hashes (first: in unions below 64), around
#: the asked similarity in which it doesn't decide but whole shingle sets do.
ERRORS, COLLISIONS = 5, (3, 6)
#: Documents of the sample from which often met shingles are learnt, and how many of those are kept. They only move shingles in the order.
SAMPLE, OFTEN = 20_000, 200_000


def _grams(tok: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owners) of all k-word shingles; a text of 1 to k - 1 words is one shingle."""
    size = np.diff(off)
    owner = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(tok)) - off[owner]
    n = np.minimum(k, size)[owner]
    start = np.flatnonzero(at + n <= size[owner])
    h = np.zeros(len(start), np.uint64)
    for j in range(k):
        on = j < n[start]
        h = np.where(on, h * np.uint64(0x9E3779B97F4A7C15) + tok[np.minimum(start + j, len(tok) - 1)], h)
    return mix(h), owner[start]


def _distinct(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner's distinct hashes, ascending."""
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[head], own[head]


def _shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owners) of the distinct five-word shingles of concatenated texts."""
    low = LOWER[data]
    start, end, owner = spans(low, off, BLANK)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = np.bincount(owner, minlength=len(off) - 1)
    return _distinct(*_grams(mix(Prefix(low).range(start, end)), np.concatenate([[0], np.cumsum(size)]).astype(np.int64), 5))


def prefixes(h: np.ndarray, own: np.ndarray, n: int, often: np.ndarray, times: np.ndarray, least: float) -> tuple[list[list[int]], np.ndarray]:
    """(prefixes, set sizes) of ``n`` texts' distinct shingles: the first ones in the order that all documents share."""
    seen = np.zeros(len(h), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, h), len(often) - 1)
        seen = np.where(often[at] == h, times[at], 0)
    order = np.lexsort((h, seen, own))
    h, own = h[order], own[order]
    size = np.bincount(own, minlength=n)
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    length = np.minimum(size, size - np.ceil(least * size - 1e-9).astype(np.int64) + 1)
    return [h[a : a + k].view(np.int64).tolist() for a, k in zip(first.tolist(), length.tolist(), strict=True)], size


def sketches(h: np.ndarray, own: np.ndarray, n: int) -> list[bytes]:
    """Of ``n`` texts' distinct shingles, ascending by text: the size of the set (4 bytes), then hashes or bins."""
    size = np.bincount(own, minlength=n)
    few = size[own] <= SMALL
    cut, who = (h[few] >> np.uint64(48)).astype(np.uint16), own[few]
    head = np.ones(len(cut), bool)
    head[1:] = (np.diff(cut) != 0) | (np.diff(who) != 0)
    kept = np.bincount(who[head], minlength=n)
    cut, ends = cut[head], np.cumsum(kept)
    large = np.flatnonzero(size > SMALL)
    bins = np.zeros((len(large), BINS), np.uint8)
    if len(large):
        h, who = h[~few], np.searchsorted(large, own[~few])
        place = who * BINS + (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        least = np.ones(len(h), bool)
        least[1:] = np.diff(place) != 0
        bins.reshape(-1)[place[least]] = (mix(h[least]) % np.uint64(255)).astype(np.uint8) + 1
    row = {int(k): bins[i] for i, k in enumerate(large)}
    return [np.uint32(size[i]).tobytes() + (row[i] if i in row else cut[ends[i] - kept[i] : ends[i]]).tobytes() for i in range(n)]


def parities(h: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """PARITY longs of each of ``n`` texts: bit by bit the parity of the count of its distinct shingles that hash to it."""
    bits = PARITY * 64
    odd = np.bincount(own * bits + (mix(h) % np.uint64(bits)).astype(np.int64), minlength=n * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.int64)


def _often(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the shingles that most often repeat in a sample of ``docs(doc_id, text)``, by hash."""

    def run(batches):
        for batch in batches:
            data, off = binary_column(batch, "text")
            for i, j in text_slices(off, SLICE):
                h, _ = _shingles(data[off[i] : off[j]], off[i : j + 1] - off[i])
                h, k = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k)], ["h", "k"])

    total = docs.count()
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < (1 << 20) * min(1.0, SAMPLE / max(total, 1)))
    found = some.select("text").mapInArrow(lean(run), "h long, k long").groupBy("h").agg(F.sum("k").alias("k")).where("k > 2").orderBy(F.desc("k"), "h").limit(OFTEN)
    got = found.toPandas()
    h, k = got["h"].to_numpy(np.int64).view(np.uint64), got["k"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], k[order]


def judge(a: list[bytes], b: list[bytes], least: float) -> tuple[np.ndarray, np.ndarray]:
    """(may be, surely is) similar, of pairs of sketches. Neither a set too small for the other nor one surely unlike may be."""
    sizes = [np.frombuffer(b"".join(x[:4] for x in side), np.uint32).astype(np.int64) for side in (a, b)]
    lesser, larger = np.minimum(*sizes), np.maximum(*sizes)
    may = lesser >= least * larger - 1e-9
    sure = may & (larger == 0)  # texts without words are alike
    few = np.flatnonzero(may & (larger <= SMALL) & (larger > 0))
    if len(few):
        keys, n = [], []
        for side in (a, b):
            got = [np.frombuffer(side[i], np.uint16, offset=4) for i in few]
            n.append(np.array([len(x) for x in got]))
            keys.append(np.concatenate(got).astype(np.int64) | np.repeat(np.arange(len(few)) << 16, n[-1]))
        both = np.bincount(np.intersect1d(*keys, assume_unique=True) >> 16, minlength=len(few))
        union = n[0] + n[1] - both
        margin = np.where(union < 64, *COLLISIONS) / union
        may[few], sure[few] = both / union >= least - margin, both / union >= least + margin
    many = np.flatnonzero(may & (lesser > SMALL))
    for i in range(0, len(many), 4096):
        part = many[i : i + 4096]
        x, y = (np.stack([np.frombuffer(side[k], np.uint8, offset=4) for k in part]) for side in (a, b))
        used = np.maximum(((x > 0) | (y > 0)).sum(1), 1)
        guess, margin = ((x == y) & (x > 0)).sum(1) / used, ERRORS * np.sqrt(least * (1 - least) / used)
        may[part], sure[part] = guess >= least - margin, guess >= least + margin
    return may, sure


def _sketched(docs: DataFrame, least: float) -> DataFrame:
    small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    often, times = _often(base)

    def run(batches):
        import xxhash

        for batch in batches:
            data, off = binary_column(batch, "text")
            sketched, fps, keys, heads, sizes, odd = [], [], [], [], [], []
            for i, j in text_slices(off, SLICE):
                part, within = data[off[i] : off[j]], off[i : j + 1] - off[i]
                h, own = _shingles(part, within)
                sketched += sketches(h, own, j - i)
                odd += parities(h, own, j - i).tolist()
                head, size = prefixes(h, own, j - i, often, times, least)
                heads += head
                sizes += size.tolist()
            for a, b in zip(off[:-1], off[1:], strict=True):
                text = data[a:b].tobytes()
                fps.append(fingerprint(text))
                keys.append(xxhash.xxh3_128_digest(b" ".join(text.lower().split())))
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), fp, pa.array(sketched, pa.binary()), pa.array(heads, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(odd, pa.list_(pa.int64()))], ["doc_id", "same", "fp", "sketch", "head", "size", "odd"])

    return base.mapInArrow(lean(run), "doc_id long, same binary, fp long, sketch binary, head array<long>, size long, odd array<long>")


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """(doc_id, grams): the sorted 64-bit hashes of the distinct five-word shingles, of ``rows(doc_id, text)``."""

    def run(batches):
        for batch in batches:
            data, off = binary_column(batch, "text")
            out = []
            for a, b in zip(off[:-1], off[1:], strict=True):
                low = LOWER[data[a:b]]
                toff = np.array([0, b - a], np.int64)
                start, end, _ = spans(low, toff, BLANK)
                tok = mix(Prefix(low).range(start, end)) if len(start) else np.zeros(0, np.uint64)
                out.append(np.unique(_grams(tok, np.array([0, len(tok)], np.int64), 5)[0]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "grams"])

    return rows.mapInArrow(lean(run), "doc_id long, grams binary")


def _scored(found: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, sure) of the pairs that the sketches leave."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("sketch").alias(f"s{x}"))
    near = found.join(side("a"), "a").join(side("b"), "b")

    def verify(batches):
        for batch in batches:
            if not len(batch):
                continue
            may, sure = judge(batch.column(2).to_pylist(), batch.column(3).to_pylist(), least)
            keep = pa.array(may)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in [*batch.columns[:2], pa.array(sure)]], ["a", "b", "sure"])

    return near.select("a", "b", "sa", "sb").mapInArrow(lean(verify), "a long, b long, sure boolean")


def _decided(scored: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Links (a, b): sure pairs, and the others whose whole shingle sets are similar enough."""
    unsure = scored.where("not sure").select("a", "b")
    asked = materialise(unsure.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "asked")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = materialise(_shingle_sets(texts.join(asked, "doc_id", "left_semi")), "shingle_sets").distinct()
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("grams").alias(f"g{x}"))

    def verify(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    exact = unsure.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ga", "gb").mapInArrow(lean(verify), "a long, b long")
    return scored.where("sure").select("a", "b").unionByName(exact)


def near_components(docs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(node, component) of the links among ``classes(rep, fp, sketch, head, size, odd)`` of distinct texts."""
    classes = classes.where("rep is not null")
    # SimHash: the first of each fingerprint meets the others of it, and the firsts of the fingerprints that link
    firsts = materialise(classes.groupBy("fp").agg(F.min("rep").alias("rep")), "firsts")
    equal = classes.select("fp", F.col("rep").alias("b")).join(firsts.withColumnRenamed("rep", "a"), "fp").where("a < b").select("a", "b")
    judged = links(firsts).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(equal)
    judged = materialise(judged, "met")
    linked = materialise(_decided(materialise(_scored(judged, classes, least), "scored"), docs, least), "links")
    comp = materialise(components(linked), "components")
    # prefixes: what travels with a key is the size of the set, and how much of it is left in the order; and the group, if any
    heads = classes.join(comp, classes["rep"] == comp["node"], "left").select("rep", "component", "size", F.posexplode("head").alias("at", "key"))
    table = heads.select("key", "rep", F.shiftleft("size", 32).bitwiseOR(F.col("size") - F.col("at")).alias("more"), "component")
    low = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1).cast("long"))
    # from the first shingle they share on, two sets have no more in common than the smaller rest
    near = F.least(low(F.col("na")), low(F.col("nb"))) * (1 + least) >= (F.shiftright("na", 32) + F.shiftright("nb", 32)) * least - 1e-6
    group = F.coalesce("component", "rep")
    size = F.shiftright("more", 32)
    buckets = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("smallest"), F.min(group).alias("lo"), F.max(group).alias("hi"))
    buckets = materialise(buckets.where("lo < hi").select("key", "n", "smallest"), "buckets")
    # nor more than their own rest: who fails with the smallest set that is large enough fails with every member
    hope = low(F.col("more")) * (1 + least) >= (size + F.greatest(F.col("smallest"), size * least)) * least - 1e-6
    shared = materialise(table.join(buckets, "key").where(hope).drop("smallest").withColumn("component", group), "shared")
    few, large = shared.where(F.col("n") <= PAIRS), shared.where(F.col("n") > PAIRS)
    odd = classes.select("rep", *[F.col("odd")[i].alias(f"odd{i}") for i in range(PARITY)])
    weight = large.groupBy("rep").agg(F.sum("n").alias("weight"))
    side = lambda df, x, *more: df.select("key", F.col("rep").alias(x), F.col("more").alias(f"n{x}"), F.col("component").alias(f"c{x}"), *more)
    found = side(few, "a").join(side(few, "b"), "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & near).select("a", "b")
    shares = F.greatest(F.lit(1), F.ceil(F.col("n") / SHARE)).cast("int")
    share = F.pmod(F.xxhash64("rep"), shares).cast("int").alias("share")
    own = lambda x: [F.col(f"odd{i}").alias(f"o{x}{i}") for i in range(PARITY)]
    large = materialise(large.join(odd, "rep").join(weight, "rep"), "large")
    # a document that leads one bucket leads the others of its size too, so that its group meets few leaders in all
    turn = F.floor(F.shiftrightunsigned(F.xxhash64("rep"), 11) / F.lit(float(1 << 53)) * F.col("n")).alias("turn")
    members, askers = side(large, "b", "n", turn, share, "weight", *own("b")), side(large, "a", share, *own("a"))
    # the most central of each share, then of the bucket: no task sorts a whole bucket
    central = members
    for by in (("key", "share"), ("key",)):
        central = central.withColumn("at", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("weight"), "b"))).where(F.col("at") <= LEADERS[0])
    bits = sum((F.bit_count(F.col(f"oa{i}").bitwiseXOR(F.col(f"ob{i}"))) for i in range(1, PARITY)), F.bit_count(F.col("oa0").bitwiseXOR(F.col("ob0"))))
    near = near & (bits * (1 + least) <= (F.shiftright("na", 32) + F.shiftright("nb", 32)) * (1 - least) + 1e-6)
    for i, until in enumerate(LEADERS):
        if i == 0:
            tell, hear = central, askers
        else:
            now = lambda df, x: df.drop(f"c{x}").join(comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
            hear = materialise(now(askers, "a"), "hear")
            mixed = hear.groupBy("key", "ca").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(F.count(F.lit(1)).alias("groups"), F.max_by("ca", "k").alias("main"))
            mixed = materialise(mixed.where("groups > 1").select("key", "main"), "mixed")
            if mixed.isEmpty():
                break
            # of two members in different groups one is outside of the largest, so it's enough that those meet everyone
            turn = members if until is None else members.where(F.col("turn") < until)
            tell, hear = now(turn, "b").join(mixed, "key").where("cb != main"), hear.join(mixed, "key", "left_semi")
        tell = tell.select("key", "b", "nb", "cb", *[f"ob{k}" for k in range(PARITY)], F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
        more = hear.join(tell, ["key", "share"]).where((F.col("ca") != F.col("cb")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        # pairs that meet in buckets of several sizes are judged once
        more = more if i else found.unionByName(more)
        more = materialise(more.distinct().join(judged, ["a", "b"], "left_anti"), "met")
        if more.isEmpty():
            continue
        judged = judged.unionByName(more)
        scored = materialise(_scored(more, classes, least), "scored")
        linked = materialise(linked.unionByName(_decided(scored, docs, least)), "links")
        comp = materialise(components(linked), "components")
    return comp


def near_groups(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, component_id) by links of similarity ``least`` or more between sets of five-word shingles: SimHash, then the rest."""
    rows = materialise(_sketched(docs, least), "sketched")
    classes = materialise(rows.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch"), F.first("head").alias("head"), F.first("size").alias("size"), F.first("odd").alias("odd")), "classes")
    comp = near_components(docs, classes, least)
    table = materialise(classes.select("same", "rep").join(comp, F.col("rep") == comp["node"], "left").select("same", F.coalesce("component", "rep").alias("component_id")), "groups")
    return rows.select("doc_id", "same").join(table, "same").select("doc_id", "component_id")


def near_dedup(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """Keep of each group of near copies the document with the smallest doc_id; columns unchanged.

    Rows without a doc_id stay; of a repeated doc_id all rows stay if one of them is the first of its group.
    """
    kept = near_groups(docs, least).where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("kept"))
    gone = materialise(kept.where("not kept").select("doc_id"), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
