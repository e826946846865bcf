import hashlib
import html
import json
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from covelake.llm import bpe_codec, chat_format, decontaminate, embed_dedup, html_extract, lm_score, quality_crf, registry, simhash_dedup, suffix_dedup, toxicity_cnn
from covelake.llm.common import components

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, kind int"
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghéñ") for _ in range(RNG.randint(1, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, copies, near copies, repeated ids, and an extra column."""
    shared, long_one = prose(60), prose(6000)
    rows = [(None, "no id"), (1, None), (2, ""), (3, " \n\t "), (4, shared), (5, shared), (5, shared), (6, prose(20) + " " + shared + " " + prose(20)), (7, "x" * 5000), (8, long_one), (9, long_one[:20000] + "!" + long_one[20000:]), (10, "ab" * 300), (10, "other row of ten")]
    rows += [(i, prose(RNG.randint(1, 80)) + "\n" + prose(5)) for i in range(11, 40)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows], DOC)


def empty(df):
    return df.where("false")


def brute_repeats(rows, size=100):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if b[p : p + size] in seen:
                gone[p : p + size] = True
            seen.add(b[p : p + size])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_suffix_dedup_is_brute_force(docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_repeats(rows)))
    assert suffix_dedup.suffix_dedup(empty(docs)).count() == 0


def test_suffix_arrays_and_pieces():
    """Levels are in lexicographic order, and windows found repeated are those of brute force, whatever the batches."""
    rng = np.random.default_rng(0)
    for letters, n, size in ((2, 3000, 16), (3, 4000, 33), (200, 2000, 100), (1, 500, 100)):
        data = rng.integers(0, letters, n, dtype=np.uint8) * np.uint8(255 // letters)
        data[n // 2 : n // 2 + 150] = data[:150]
        at = rng.permutation(n - size + 1)
        text = data.tobytes()
        order, head = suffix_dedup.Family(data, size).sort(at)
        cut = [text[i : i + size] for i in order]
        assert cut == sorted(cut) and head.tolist() == [True, *(x != y for x, y in zip(cut, cut[1:], strict=False))]
        seen, want = set(), []
        for i in at:
            want.append(text[i : i + size] in seen)
            seen.add(text[i : i + size])
        for batch in (64, 700, 1 << 18):
            assert suffix_dedup.repeated(data, at, size, batch=batch).tolist() == want
    none = np.zeros(0, np.uint64)
    text = np.frombuffer(prose(300000).encode(), np.uint8)
    assert sum(g[4].sum() for s, e, w, _, _ in suffix_dedup.pieces(np.array([0, len(text)]), 100) for g in [suffix_dedup.groups(text[s:e], w, 100, none)]) == len(text) - 99


def test_one_anchor_in_every_document(spark, monkeypatch):
    """A stub in ever new surroundings, counted as common or not, and matches across the pieces of a long text."""
    stub = "Licensed under the terms of a well known public license. "
    rows = [(i, prose(8) + stub + prose(RNG.randint(3, 30)) + stub * (i % 3)) for i in range(60)]
    rows += [(60, prose(2500) + rows[3][1] + prose(3000)), (61, rows[3][1][20:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, brute_repeats(rows)))
    for often, piece, flush in ((2, 5000, 100), (1000, 1 << 19, 400_000)):
        monkeypatch.setattr(suffix_dedup, "OFTEN", often)
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        monkeypatch.setattr(suffix_dedup, "FLUSH", flush)
        assert (len(suffix_dedup.common_anchors(df.withColumnRenamed("doc_id", "sid"), 100)) > 0) == (often == 2)
        assert sorted(map(str, map(tuple, suffix_dedup.suffix_dedup(df).collect()))) == want


def test_corpus_of_batches(spark, docs, tmp_path):
    """Batches give the rows of one table in their order; levels merge geometrically; a failed batch leaves nothing."""
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()]
    rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    parts = [rows[i : i + 8] for i in range(0, len(rows), 8)]
    corpus, got, sizes = suffix_dedup.Corpus(spark, f"file://{tmp_path}/corpus"), [], []
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, "doc_id long, text string")
        if i == 2:
            with pytest.raises(Exception, match="nowhere"):
                corpus.add(df, text_col="nowhere")
        got += [tuple(r) for r in corpus.add(df).collect()]
        sizes.append([n for _, n in corpus.levels()[1]])
    # a repeated doc_id never crosses a batch here, so the order is that of one table
    assert all(len({r[0] for r in a} & {r[0] for r in b}) == 0 for a, b in zip(parts, parts[1:], strict=False))
    assert sorted(map(str, got)) == sorted(map(str, brute_repeats(rows)))
    assert sizes[:4] == [[8], [16], [16, 8], [32]] and corpus.levels()[0] == len(parts)


def test_drop_repeats_with_clashing_names(spark):
    names = ["n_removed", "kept_text", "sid", "_sid", "key"]
    df = spark.createDataFrame([(1, "alpha", *range(5)), (None, None, *range(5)), (2, "", *range(5))], ["doc_id", "text", *names])
    got = suffix_dedup.drop_repeats(df)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(str(r) for r in df.fillna("", ["text"]).collect())
    assert suffix_dedup.drop_repeats(empty(df)).count() == 0


def test_drop_repeats_keeps_each_row(spark):
    """Rows without a doc_id stay, and rows that share one keep their own columns, once each."""
    shared = prose(60)
    rows = [(None, f"{shared} one", "a"), (None, "no id either", "b"), (5, f"five {shared}", "c"), (5, "other five", "d"), (5, "third five", "e"), (6, shared, "f"), (7, "plain", "g")]
    got = suffix_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, tag string"))
    assert got.columns == ["doc_id", "text", "tag"]
    got = {(r.doc_id, r.tag): r.text for r in got.collect()}
    assert set(got) == {(d, t) for d, _, t in rows if t != "f"} and len(got) == 6  # the sixth repeats the first as a whole
    assert all(got[d, t] == x for d, x, t in rows if t in "abdeg") and got[5, "c"].startswith("five") and shared[:100] not in got[5, "c"]
    one = suffix_dedup.drop_repeats(spark.createDataFrame(rows[3:4] + rows[5:], "doc_id long, text string, tag string"))
    assert sorted((r.doc_id, r.tag, r.text) for r in one.collect()) == [(5, "d", "other five"), (6, "f", shared), (7, "g", "plain")]


def brute_components(ids, linked):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(best[a], best[b])
            if best[a] != low or best[b] != low:
                best[a] = best[b] = low
                changed = True
    return best


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute_components({x for e in edges for x in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_is_brute_force(docs):
    import xxhash

    def brute(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    with_id = docs.where("doc_id is not null")
    rows = [(r.doc_id, brute(r.text)) for r in with_id.collect()]
    got = simhash_dedup.simhash_groups(with_id).collect()
    assert sorted((r.doc_id, r.fp % (1 << 64)) for r in got) == sorted(rows)
    linked = [(a, b) for a, x in rows for b, y in rows if (x ^ y).bit_count() <= 2]
    assert {r.doc_id: r.component_id for r in got} == brute_components([i for i, _ in rows], linked)
    assert simhash_dedup.simhash_groups(empty(docs)).count() == 0


def test_ball_meets_every_pair_within_two_bits(spark):
    base = RNG.getrandbits(63)
    fps = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(0, 63, 7) for j in range(1, 63, 9) if i != j]
    fps = sorted(set(fps))
    rows = spark.createDataFrame([*enumerate(fps)], "rep long, fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash_dedup.links(rows).collect()}
    assert got == {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 2}


def test_near_groups_by_similarity(spark):
    base = prose(400).split()
    near, far = list(base), list(base)
    near[200] = "edited"
    for i in range(0, 400, 6):
        far[i] = f"w{i}"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base).encode().upper().decode()), (5, prose(300)), (6, None), (7, "")]
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6, 7: 6}


def edited_copies(edits, bases=3):
    rows = []
    for _ in range(bases):
        base = prose(300).split()
        for n in edits:
            text = list(base)
            for i in RNG.sample(range(300), n):
                text[i] = f"new{RNG.random()}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_near_groups_are_those_of_all_pairs(spark):
    """Similarities of 0.85 and more or well below 0.8, where the segments' meeting is practically sure."""
    rows = edited_copies((0, 1, 2, 2, 1, 60, 90, 60))
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert near and got == brute_components(range(len(rows)), near)


def test_large_buckets_lose_no_group(spark, monkeypatch):
    """Buckets compared in rounds give the groups of all pairs within them, at similarities around the threshold too."""
    df = spark.createDataFrame(edited_copies((3, 8, 14, 3, 8, 14, 5, 5, 25, 40, 60, 90)), "doc_id long, text string")
    groups = lambda: {r.doc_id: r.component_id for r in simhash_dedup.near_groups(df).collect()}
    whole = groups()
    assert len(set(whole.values())) < len(whole)
    monkeypatch.setattr(simhash_dedup, "PAIRS", 1)
    monkeypatch.setattr(simhash_dedup, "LEADERS", (1, 2, None))
    monkeypatch.setattr(simhash_dedup, "SHARE", 3)
    assert groups() == whole


def test_sketches_decide_only_what_sets_decide():
    """What a sketch calls sure or drops is so by whole sets, for hashed sets, bins, and pairs of both."""
    rng = np.random.default_rng(4)
    texts, pairs = [], []
    for n in [0, 1, 3, 12, 40, 150, 200, 240, 256, 262, 280, 400, 3000] * 6:
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.0, 0.05, 0.1, 0.111, 0.13, 0.2, 0.6):
            other = base.copy()
            k = int(n * share)
            other[:k] = rng.integers(0, 1 << 63, k, dtype=np.uint64)
            texts += [base, other[: max(n - int(share * 10), 0)]]
            pairs.append((len(texts) - 2, len(texts) - 1))
    texts = [np.unique(t) for t in texts]
    own = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    sk = simhash_dedup.sketches(np.concatenate(texts), own, len(texts))
    may, sure = simhash_dedup.judge([sk[a] for a, _ in pairs], [sk[b] for _, b in pairs], 0.8)
    real = np.array([len(np.intersect1d(texts[a], texts[b])) >= 0.8 * len(np.union1d(texts[a], texts[b])) for a, b in pairs])
    assert (may | ~real).all() and (real | ~sure).all() and sure.any() and not may.all()


def test_near_groups_find_repeated_lines_and_inserted_blocks(spark, monkeypatch):
    """Copies whose set of shingles is near, though their words are repeated, or edited in one block, are those of all pairs."""
    rows = []
    for _ in range(6):
        base, line = prose(400), prose(12)
        words = base.split()
        for text in (f"{base} {line}", f"{base} {' '.join([line] * 20)}", f"{' '.join([line] * 60)} {base}", f"{base} {prose(60)}", f"{' '.join(words[:200])} {prose(90)} {' '.join(words[200:])}", " ".join(words[:330])):
            rows.append((len(rows), text))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b c d e f g h", "a b c d e f g h i", "x y", "x y z", " ".join("klmnopqrstuvwx"), " ".join("klmnopqrstuvwxy")])]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for _, t in rows)]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = lambda: {r.doc_id: r.component_id for r in simhash_dedup.near_groups(df).collect()}
    want = brute_components(range(len(rows)), near)
    assert near and groups() == want
    monkeypatch.setattr(simhash_dedup, "PAIRS", 1)
    monkeypatch.setattr(simhash_dedup, "LEADERS", (1, None))
    assert groups() == want


def test_near_groups_of_many_copies_meet_few_pairs(spark, monkeypatch):
    """Pairs that are judged grow with a group of copies, not with its square; groups are still those of all pairs.

    The first group has central texts, which others are near to; in the second all copies differ too much from each other.
    """
    rng = random.Random(5)
    rows = []
    for edits, n in (((0, 1, 2, 3, 3, 4, 5), 420), ((2,), 120)):
        base = [f"{rng.choice(WORDS)}{rng.random()}" for _ in range(150)]
        for i in range(n):
            text = list(base)
            for k in rng.sample(range(150), edits[i % len(edits)]):
                text[k] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(text)))
    met, scored = [], simhash_dedup._scored

    def spy(found, classes, least):
        met.append(found.count())
        return scored(found, classes, least)

    monkeypatch.setattr(simhash_dedup, "_scored", spy)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(near) > 20 * len(rows) and got == brute_components(range(len(rows)), near)
    assert sum(met) < 6 * len(rows)


def test_parities_reject_only_what_differs():
    """No more bits differ than shingles, whatever the sizes; sets far below the threshold differ in more bits than it allows."""
    rng = np.random.default_rng(6)
    for n, k in [(0, 0), (1, 1), (146, 5), (146, 15), (146, 30), (146, 60), (3000, 100), (3000, 3000)]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[k:], rng.integers(0, 1 << 63, k // 2, dtype=np.uint64)]))
        odd = simhash_dedup.parities(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
        assert odd.shape == (2, simhash_dedup.PARITY)
        bits, apart = int(np.unpackbits((odd[0] ^ odd[1]).view(np.uint8)).sum()), len(np.setxor1d(a, b))
        assert bits <= apart and (bits - apart) % 2 == 0
        if (n, k) == (146, 60):
            assert bits > (len(a) + len(b)) / 9


def test_bpe_is_the_public_library(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe_codec.default_path())
    extra = ["<|endoftext|> a<|endoftext|>", "it's'll 123 ４５ ½\t\t x", "\u0085　 x\x1c\n\n y", "\U0001f600 ﬁn", " " * 50 + "end"] + ["".join(RNG.choice("theaning  \n'.,!0129éñßÀ中日\U0001f600") for _ in range(40)) for _ in range(300)]
    extra += ["".join(RNG.choice("theaningsor") for _ in range(bpe_codec.LONG_WORD + d)) for d in (-2, -1, 0, 1, 200) for _ in range(20)]
    rows = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame([(1000 + i, x) for i, x in enumerate(extra)], "doc_id long, text string"))
    want = []
    for r in rows.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, bpe_codec.bpe_digests(rows).collect()))) == sorted(map(str, want))
    c = bpe_codec.codec(bpe_codec.default_path())
    assert all(c.decode(c.encode(x)) == x for x in extra)
    assert bpe_codec.bpe_digests(empty(docs)).count() == 0


def test_tiling_catches_reordered_passages(spark):
    item = [f"word{i}" for i in range(40)]
    turned = item[20:40] + ["filler"] * 9 + item[0:20]
    rows = [(1, "A start. " + " ".join(item) + " end"), (2, " ".join(turned)), (3, " ".join(item[:20])), (4, prose(50)), (5, None), (6, ""), (1, " ".join(item))]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "two words"), (7, " ".join(item).upper())], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted({(r.doc_id, r.item_id, r.covered_words, r.n_tiles) for r in got}) == [(1, 7, 40, 1), (2, 7, 40, 2)]
    assert len(got) == 6  # two rows of document 1, and two copies of the item
    assert decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench.where("false")).count() == 0
    many = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench, block_bytes=64)
    assert sorted(map(str, many.collect())) == sorted(map(str, got))


def naive_tiling(item, doc, k):
    """Greedy string tiling by definition: longest common run of unmarked words, first in the item, then in the document."""
    used_i, used_j, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (k - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_i[i + n] and not used_j[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return sum(t for t, *_ in tiles), len(tiles)
        tiles.append(best)
        used_i[i : i + n] = [True] * n
        used_j[j : j + n] = [True] * n


@pytest.mark.parametrize("chunk, diagonals", [(1 << 20, 1 << 20), (7, 1 << 20), (50, 6)])
def test_tiling_is_naive_tiling(monkeypatch, chunk, diagonals):
    monkeypatch.setattr(decontaminate, "CHUNK", chunk)
    monkeypatch.setattr(decontaminate, "DIAGONALS", diagonals)
    rng = random.Random(chunk)
    for case in range(60):
        letters = "abc"[: 1 + case % 3]
        items = [[rng.choice(letters) for _ in range(rng.randint(1, 25))] for _ in range(3)]
        docs = [[rng.choice(letters) for _ in range(rng.randint(0, 40))] for _ in range(3)] + [items[0][4:] + ["z"] + items[0][:4] + items[1]]
        k = rng.choice((2, 3, 5))
        index = decontaminate.Index([0, 1, 2], [" ".join(x).encode() for x in items], k)
        text = [" ".join(x).encode() for x in docs]
        tok, off = decontaminate.tokens(np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in text])]))
        for threshold in (0.0, 0.8):
            got = {(d, m): (c, n) for d, m, c, n in index.matches(tok, off, threshold)}
            want = {(d, m): naive_tiling(items[m], docs[d], min(k, len(items[m]))) for d in range(4) for m in range(3)}
            assert got == {key: v for key, v in want.items() if v[0] and v[0] >= threshold * len(items[key[1]])}


def test_tiling_of_one_word_repeated(spark):
    """300,000 times one word against an item of the same word, in bounded memory; and rows are judged one by one."""
    import tracemalloc

    index = decontaminate.Index([0], [b"word " * 100], 5)
    text = np.frombuffer(b"word " * 300_000, np.uint8)
    tok, off = decontaminate.tokens(text, np.array([0, len(text)]))
    tracemalloc.start()
    assert list(index.matches(tok, off, 0.8)) == [(0, 0, 100, 1)]
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
    item = " ".join(f"word{i}" for i in range(40))
    rows = [(1, item, 1, "a"), (1, "clean", 1, "b"), (None, item, 1, "c"), (None, "clean too", 1, "d"), (2, None, 1, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int, coverage string")
    bench = spark.createDataFrame([(7, item), (8, prose(30)), (None, "clean too")], "item_id long, text string")
    for size in (16 << 20, 64):
        got = decontaminate.decontaminate(df, bench, block_bytes=size)
        assert got.columns == df.columns and sorted(r.coverage for r in got.collect()) == ["b", "d", "e"]
        assert sorted(map(str, ((r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, block_bytes=size).collect()))) == ["(1, 7)", "(None, 7)"]
        assert decontaminate.contaminated(empty(df), bench, block_bytes=size).count() == decontaminate.decontaminate(empty(df), bench, block_bytes=size).count() == 0


def test_pq_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    near = [x[i % 40] + rng.normal(size=16) * s for i, s in zip(range(300), np.tile([0.02, 0.1, 0.2], 100), strict=True)]
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate([*x, *near, *x[:5], x[3] * 2])]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [float("inf")] + [1.0] * 15), (904, [1.0]), (905, [None] + [1.0] * 15), (906, [])]
    got = embed_dedup.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"), sample=400).toPandas().set_index("vec_id")
    m = np.array([r for _, r in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    s = m @ m.T >= 0.9
    np.fill_diagonal(s, False)
    assert len(got) == len(rows) + 7 and (got.n_links[[i for i, _ in odd]] == 0).all() and got.kept[[i for i, _ in odd]].all()
    assert got.n_links[: len(rows)].sum() / s.sum() >= 0.98 and (got.n_links[: len(rows)].to_numpy() <= s.sum(1)).all()
    comp = brute_components(range(len(rows)), zip(*np.nonzero(s), strict=True))
    assert np.mean([got.component_id[i] == comp[i] for i in comp]) >= 0.98
    assert embed_dedup.near_vectors(spark.createDataFrame(odd, "vec_id long, embedding array<float>").where("false")).count() == 0


def brute_vectors(rows):
    m = np.array([r for _, r in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.9
    np.fill_diagonal(near, False)
    return near.sum(1), brute_components(range(len(rows)), zip(*np.nonzero(near), strict=True))


@pytest.mark.parametrize("cell, queries", [(4096, 16_384), (150, 60), (40, 500)])
def test_pairs_of_vectors_are_judged_once(spark, monkeypatch, cell, queries):
    """A dense group that fills cells and blocks, pairs around the threshold and clashing column names: links are those of brute force."""
    monkeypatch.setattr(embed_dedup, "CELL", cell)
    monkeypatch.setattr(embed_dedup, "QUERIES", queries)
    rng = np.random.default_rng(8)
    hot = rng.normal(size=16)
    x = [*(hot + rng.normal(size=(250, 16)) * 0.2), *rng.normal(size=(200, 16))]
    x += [v + rng.normal(size=16) * 0.25 for v in x[250:400]] + [x[3]] * 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0, 0, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, v int, n int, k1 int, rep int")
    got = embed_dedup.near_vectors(df, sample=500).toPandas().set_index("vec_id").sort_index()
    links, comp = brute_vectors(rows)
    assert links.max() > 200 and (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.99 * links.sum()
    assert np.mean([got.component_id[i] == comp[i] for i in comp]) > 0.99


def test_vectors_of_doubles(spark):
    """Doubles decide in double precision, and tiny vectors aren't zero."""
    a, b = [1.0, 0.0], [0.9, math.sqrt(1 - 0.9**2) * (1 + 1e-12)]  # a little below 0.9 in doubles only
    rows = [(1, a), (2, b), (3, [1e-50, 0.0]), (4, [-1e-300, 1e-310]), (5, [1.0, 0.0, 0.0]), (None, a)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4), 5: (0, 5), None: (0, None)}


def test_members_compared_stay_flat():
    """Members that a query meets don't grow with the table."""
    rng = np.random.default_rng(2)
    met = []
    for n in (10_000, 50_000):
        x = rng.normal(size=(n, 32))
        x /= np.linalg.norm(x, axis=1)[:, None]
        index = embed_dedup.Index(x[:5000], n, 0.9)
        own, q = embed_dedup._nearest(x, index.cells), x[:200]
        look, total = embed_dedup._probes(q, index.cells, embed_dedup.PROBE_CELLS, index.r), 0
        for cell in range(len(index.cells)):
            members = x[own == cell]
            for block in np.array_split(members, -(-len(members) // embed_dedup.CELL)):
                lists = embed_dedup.Block(index, block)
                asks = embed_dedup._probes(q[look[:, cell]], lists.centre, embed_dedup.PROBE_LISTS, index.r)
                total += int((asks @ np.bincount(lists.own, minlength=len(lists.centre))).sum())
        met.append(total / len(q))
    assert met[1] < 1.5 * met[0]


def test_main_text(spark):
    page = "<html><head><title>t</title></head><body><header>Top</header><nav>a b</nav><div class='cookie-notice'>ok?</div><article><header><h1>T &amp; x</h1></header><p>One<br>two <b>three</b><p>Four<script>var a='</p>'</script><aside>side</aside><form>f</form></article><section id=comments><p>hi</p></section><footer>f</footer>"
    plain = lambda body: f"<body><div>{' '.join(f'menu{i}' for i in range(12))}</div><p>{body}</p></body>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, "http://h/3", ""), (4, "http://k/1", plain("first body")), (5, "http://k/2", plain("second body")), (6, None, "<p>un<b>closed"), (6, "http://k/9", "text only")]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == [(i, t, len(t)) for i, t in [(1, "T & x\nOne two three\nFour"), (2, ""), (3, ""), (4, "first body"), (5, "second body"), (6, "text only"), (6, "unclosed")]]


def test_copies_of_a_page_are_no_repetition(spark):
    """A page without main text that stands on a host twice keeps its text; what distinct pages share goes."""
    menu, body = " ".join(f"menu{i}" for i in range(12)), prose(30)
    page = lambda x: f"<body><div>{menu}</div><p>{x}</p></body>"
    rows = [(1, "http://h/1", page(body)), (2, "http://h/2", page(body)), (2, "http://h/2", page(body)), (3, "http://k/1", page(body)), (4, "http://k/2", page(body)), (5, "http://k/3", page("other body"))]
    got = sorted((r.page_id, r.text) for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == [(1, f"{menu}\n{body}"), (2, f"{menu}\n{body}"), (2, f"{menu}\n{body}"), (3, body), (4, body), (5, "other body")]


def texts_of_pages(spark, rows, **how):
    df = spark.createDataFrame([(i, u, h, "a", 1, 2, "b") for i, u, h in rows], "page_id long, url string, html string, text string, rid int, kind int, main string")
    return {r.page_id: r.text for r in html_extract.main_texts(df, **how).collect()}


def test_host_judges_what_markup_does_not(spark):
    """Open pages against brute force over all runs of the host's pages; a site's block inside articles; both stay without the method."""
    rng, rows, open_blocks = random.Random(5), [], {}
    words = [f"w{i}" for i in range(60)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 14))) for _ in range(6)]
    for i in range(30):
        own = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(3)]
        parts = [rng.choice(shared) + rng.choice(["", " own tail"]), own[0], rng.choice(shared) + " " + own[1], own[2], rng.choice(shared)]
        open_blocks[i] = (f"h{i % 3}", parts)
        rows.append((i, f"https://u@h{i % 3}:80/{i}", "<body>" + "".join(f"<div>{p}</div>" for p in parts)))
    extra, about = "Read all of our stories in the app", [prose(20) for _ in range(20)]
    rows += [(100 + i, f"//site/{i}", f"<article><p>{about[i]}</p><p>{extra}</p><p>{about[0][:50] if i % 4 == 0 else about[i][::-1]}</p></article>") for i in range(20)]
    rows += [(200 + i, f"//few/{i}", f"<article><p>{extra}</p><p>{about[i]}</p></article>") for i in range(5)]  # too few pages to tell
    where = {}
    for i, (host, parts) in open_blocks.items():
        stream = " ".join(parts).split()
        for k in range(max(1, len(stream) - 7)):
            where.setdefault((host, *stream[k : k + 8]), set()).add(" ".join(parts))
    got = texts_of_pages(spark, rows)
    for i, (host, parts) in open_blocks.items():
        stream = " ".join(parts).split()
        gone = {k for k in range(max(1, len(stream) - 7)) if len(where[(host, *stream[k : k + 8])]) > 1}
        assert got[i] == html_extract.keep_unique(parts, gone)
    clean = [about[0][:50].strip() if i % 4 == 0 else about[i][::-1] for i in range(20)]
    assert all(got[100 + i] == f"{about[i]}\n{clean[i]}" for i in range(20)) and all(got[200 + i] == f"{extra}\n{about[i]}" for i in range(5))
    plain = texts_of_pages(spark, rows, by_host=False)
    assert all(plain[i] == "\n".join(parts) for i, (_, parts) in open_blocks.items()) and plain[101] == f"{about[1]}\n{extra}\n{clean[1]}"


def test_markup_that_loses_no_article(spark):
    art = "<article><p>Hello there</p></article>"
    pages = [
        "<html><head><title>t</title><body><article><p>Hello there</article>", f"<title>t</title>{art}", f'<div class="with-sidebar">{art}<div class="sidebar">x</div></div>', '<article class="post tag-related category-ads"><p>Hello there</p></article>',
        '<article><section class="search-results"><p>Hello there</p></section><div class="search">q</div></article>', f'<div class="ads-layout">{art}</div>', '<article><p>Hello there</p></article><section id="comments"><article>no</article></section>', '<div class="related-posts"><article class="card">no</article></div><main><p>Hello there</p></main>',
        f'{art}<article class="comment-body">no</article>', '<article><p class="x>Hello there</p></article>', "<article><p>Hello <b>there</i></p></article>", '<body><header>no</header><div role="main"><header>Hello</header> there</div>', "<ul><li>Hello<li>there</ul>",
        '<article><p>Hello<a href="a>b">there</a></p><!-- never closed </article>', "<article>a < b <5 Hello</article>", "<p>Hello</p><template><article>no</article></template>",
    ]
    got = texts_of_pages(spark, [(i, f"http://host{i}/", h) for i, h in enumerate(pages)])
    assert [got[i] for i in range(10)] == ["Hello there"] * 10
    assert [got[i] for i in range(10, 16)] == ["Hello there", "Hello\nthere", "Hello\nthere", "Hellothere", "a < b <5 Hello", "Hello"]


@pytest.mark.parametrize("piece", ["<xmp>", '<a "', "<a =\"x", "<b>", "<p><b>", "</i>", "<div></div><b>", "<!", "<![CDATA[", "<", "</", "&amp", '<a class="', "<li><b></li>", "<title>", "class ="])
def test_time_is_linear(piece):
    import time

    html_extract.blocks(piece * 100)
    began = time.perf_counter()
    html_extract.blocks(piece * (1 << 20 >> 2))
    assert time.perf_counter() - began < 12


def test_main_text_of_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.main_texts(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", body)]
        assert got[r.page_id] == "\n".join(b for b in want if b)
    assert html_extract.main_texts(empty(pages)).count() == 0


def test_lattice_is_the_sum_over_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"] + [""] * 256 + [""]
    rng = np.random.default_rng(1)
    w = rng.random(len(pieces))
    logp = np.log(w / w.sum())
    ids = list(range(7, 263))
    lat = lm_score.Lattice(pieces, ids, logp)

    def brute(text):
        if not text:
            return 1.0
        total = np.exp(sum(logp[ids[b]] for b in text[0].encode())) * brute(text[1:])
        return total + sum(np.exp(logp[i]) * brute(text[len(p) :]) for i, p in enumerate(pieces) if p and text.startswith(p))

    words = [b"ab", b"abba", "aé".encode(), b"bab"]
    assert np.allclose(lat.log_probs(words), [np.log(brute("▁" + x.decode())) for x in words])
    got = lat.expect(words, np.ones(4))
    for k in (1, 3, 5):  # expected counts are derivatives of the log probability by the log weights
        up = logp.copy()
        up[k] += 1e-6
        slope = (lm_score.Lattice(pieces, ids, up).log_probs(words).sum() - lat.log_probs(words).sum()) / 1e-6
        assert abs(slope - got[k]) < 1e-4


def test_lm_score_is_the_sum_over_segmentations(spark):
    """Scores of whole small texts against weights re-estimated and segmentations summed by brute force."""
    import math
    import zlib
    from collections import Counter

    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"] + [""] * 256 + [""]
    first = np.arange(1, len(pieces) + 1, dtype=float)
    first /= first.sum()
    spelling = list(range(7, 263))

    def ways(text, w):
        """(probability, pieces) of all segmentations."""
        if not text:
            return [(1.0, ())]
        own = [(w[p], (p,), len(pieces[p])) for p in range(7) if text.startswith(pieces[p])]
        own.append((math.prod(w[spelling[x]] for x in text[0].encode()), tuple(spelling[x] for x in text[0].encode()), 1))
        return [(q * r, ps + rest) for q, ps, n in own for r, rest in ways(text[n:], w)]

    rows = [(i, t) for i, t in enumerate(["ab ab b", "BA a", "", None, "abab zz", "é a\tb", "b ab", "a"])]
    words = {i: [x.decode() for x in (t or "").encode().lower().split()] for i, t in rows}
    train = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    count, w = Counter(x for i in train for x in words[i]), first
    for _ in range(4):  # three rounds over the common words, here all, and one over all
        total = first * 50.0
        for x, n in count.items():
            found = ways("▁" + x, w)
            z = sum(q for q, _ in found)
            for q, ps in found:
                for p in ps:
                    total[p] += n * q / z
        total[-1] += len(train)
        w = total / total.sum()
    want = {i: math.log10(w[-1]) + sum(math.log10(sum(q for q, _ in ways("▁" + x, w))) for x in words[i]) for i, _ in rows}
    table = (pieces, spelling, np.log(first))
    got = lm_score.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary_path=table).collect()
    assert len(got) == len(rows) and all(abs(r.score - want[r.doc_id]) < 1e-9 for r in got)


def test_lm_base_score(docs):
    import math
    import zlib
    from collections import Counter

    with_id = docs.where("doc_id is not null")
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in with_id.collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in rows if not held(i) for w in ws)
    ends = sum(not held(i) for i, _ in rows)
    n, v = sum(c.values()) + ends, len(c) + 1
    z = n + 0.5 * (v + 1)
    want = sorted((i, held(i), len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(sum(math.log10((c[w] + 0.5) / z) for w in ws) + math.log10((ends + 0.5) / z), 6)) for i, ws in rows)
    mixed = []
    for top in (50, 100_000):  # words outside the broadcast take the join
        got = lm_score.lm_scores(with_id, top_words=top, warm_words=50).collect()
        assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 and math.isfinite(r.score) and math.isfinite(r.mixed_score) for r in got)
        mixed.append(sorted((r.doc_id, r.n_tokens, round(r.score, 6), round(r.mixed_score, 6)) for r in got))
    assert mixed[0] == mixed[1]  # whatever the size of the table
    assert lm_score.lm_scores(empty(docs)).count() == 0


@pytest.mark.parametrize("f, label", [(quality_crf.quality_scores, "quality"), (toxicity_cnn.toxicity_scores, "toxic")])
def test_classifiers(spark, docs, f, label):
    d, y = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = f(d, y).join(y, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held[label]).mean() > (0.95 if label == "quality" else 0.85)
    assert ((got.score >= 0) & (got.score <= 1)).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert f(docs, y.where("false")).select("score").distinct().collect()[0].score == 0.5  # no labels
    odd = f(docs, y)
    assert odd.count() == docs.count() and odd.where("score is null or isnan(score)").count() == 0
    assert f(empty(docs), y).count() == 0


def test_crf_marginals_are_brute_force():
    rng = np.random.default_rng(0)
    unary, trans = rng.normal(size=(4, 2)), rng.normal(size=(2, 2))
    from itertools import product

    paths = [(p, np.exp(sum(unary[i, s] for i, s in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:], strict=False)))) for p in product((0, 1), repeat=4)]
    z = sum(w for _, w in paths)
    got, _ = quality_crf.marginals(unary, np.array([4]), trans)
    assert np.allclose(got, [sum(w for p, w in paths if p[i]) / z for i in range(4)])


def test_tool_calls(spark):
    calls = spark.createDataFrame([("a", 1, "t", '{"x":1}', None), ("b", 1, "t", '{"x":"z"}', "a"), ("c", 1, "u", "{}", "b"), ("d", 2, "t", '{"x":2}', "e"), ("e", 2, "t", '{"x":2}', "d"), ("a", 1, "t", '{"x":1}', None)], "call_id string, conv_id long, tool string, arguments string, after_id string")
    results = spark.createDataFrame([("a", 1, "ok"), ("a", 1, "ok"), ("zz", 3, None)], "call_id string, conv_id long, content string")
    schema = {"t": {"properties": {"x": {"type": "integer", "minimum": 1}}, "required": ["x"]}}
    got = {r.call_id: (r.step, r.status, r.error, r.n_calls, r.n_results) for r in chat_format.link_calls(calls, results, schema).collect()}
    assert got == {"a": (1, "ok", None, 2, 2), "b": (2, "invalid", "type:x", 1, 0), "c": (3, "invalid", "unknown:tool", 1, 0), "d": (None, "cycle", None, 1, 0), "e": (None, "cycle", None, 1, 0), "zz": (None, "orphan result", None, 0, 1)}


def test_tool_arguments(spark):
    """Types by the parsed value, malformed JSON, canonical order at every level, and equal arguments in another order."""
    args = ['{"x": 5, "b": {"d": [1, {"z": 1, "a": null}], "c": 2}}', '{"b":{"c":2,"d":[1,{"a":null,"z":1}]},"x":5}', '{"x":"5"}', '{"x":1.5}', '{"x":1.0}', "{x", None, '{"x":null}', "[1]", '{"x":1,"s":7}', '{"x":1,"s":"q"}', '{"x":1,"l":{}}', '{"x":1,"l":[2],"o":{},"f":1}', '{"x":1,"x":2}', '{"x":99}']
    schema = {"t": {"properties": {"x": {"type": "integer", "maximum": 50}, "s": {"type": "string", "enum": ["p"]}, "l": {"type": "array"}, "o": {"type": "object"}, "f": {"type": "boolean"}}, "required": ["x"]}}
    calls = spark.createDataFrame([(f"c{i:02}", 1, "t", a, None, "x") for i, a in enumerate(args)] + [("c00", 1, "t", args[1], None, "x"), ("c02", 1, "t", args[1], None, "x")], "call_id string, conv_id long, tool string, arguments string, after_id string, step string")
    got = chat_format.link_calls(calls, spark.createDataFrame([], "call_id string, conv_id long, content string"), schema).orderBy("call_id").collect()
    assert [r.error for r in got] == [None, None, "type:x" if min(args[1], args[2]) == args[2] else None, "type:x", None, "json", "json", "missing:x", "type:arguments", "type:s", "enum:s", "type:l", "type:f", "json", "maximum:x"]
    assert [json.loads(r.canonical)["arguments"] for r in got[:2]] == ['{"b":{"c":2,"d":[1,{"a":null,"z":1}]},"x":5}'] * 2
    assert [r.conflict for r in got[:3]] == [False, False, True] and [r.n_calls for r in got[:3]] == [2, 1, 2]


TURNS = "conv_id long, turn long, role string, text string, own string, n string, met string"


def test_kept_ids_are_linked(spark):
    """Turns that keep an id are followed and answered by it; long chains, nulls, repeated rows, clashing names and the SQL for them."""
    import duckdb

    rows = [(1, 0, "user", '{"id":"q1","a":1}'), (1, 1, "assistant", "plain answer"), (1, 2, "user", "next"), (1, 3, "assistant", '{"id":"q9"}'), (1, 4, "tool", "x"), (2, 0, "user", None), (2, 1, "assistant", None), (2, 2, "system", "")]
    rows += [(None, 0, "user", "a"), (3, None, "user", "a"), (2, 1, "assistant", None), (4, 0, "user", "{broken"), (4, 1, "assistant", '{"id":7}'), (5, 0, "user", '{"id":"s"}'), (5, 2, "user", '{"id":"s"}'), (5, 4, "user", '{"id":"t"}'), (6, 9, "user", "x" * 5000)]
    rows += [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(130)]
    df = spark.createDataFrame([(*r, "own", "n", "met") for r in rows], TURNS)
    out = chat_format.link_calls(*chat_format.from_conversations(df), chat_format.SCHEMAS)
    got = {r.call_id: r for r in out.collect()}
    assert (got["1:q1"].status, got["1:q1"].step, got["1:2"].step, got["1:2"].status, got["1:q9"].status, got["1:4"].step) == ("ok", 1, 2, "no result", "orphan result", 3)
    assert json.loads(got["1:q1"].canonical)["result"] == "plain answer"
    assert (got["2:0"].error, got["2:0"].n_results, got["2:2"].error, got["4:0"].status, got["4:7"].status, got["6:9"].status) == ("missing:text", 2, "minLength:text", "no result", "orphan result", "no result")
    assert got["9:128"].step == 65 and got["5:s"].conflict and got["5:t"].status == "no result"  # of the two calls s, the least follows nothing
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    cols = sorted(out.columns)
    assert same(out.select(*cols).collect()) == same(con.execute(f"select {', '.join(cols)} from ({chat_format.ORACLE})").fetchall())
    assert chat_format.link_calls(*chat_format.from_conversations(empty(df)), chat_format.SCHEMAS).count() == 0


def same(rows):
    return sorted(tuple(str(None if pd.isna(v) else v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    assert same(df.select(*cols).collect()) == same(con.execute(f"select {', '.join(cols)} from ({registry.ORACLES[name]})").fetchall())


def test_pipeline_keeps_what_each_stage_keeps(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first, seen = docs, None
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, first, DATA)
        assert out.columns == docs.columns
        ids = {r.doc_id for r in out.collect()}
        assert seen is None or ids <= seen
        first, seen = out, ids
    got = p.run(spark, DATA).collect()
    assert {r.doc_id for r in got} == seen and len(got) == len(seen)


CLASHES = ["held_out", "score", "sid", "component", "component_id", "key", "n", "fp", "rep", "group", "word", "rid", "same", "label", "y", "o"]


def test_clashing_names_change_nothing(spark, docs):
    """Extra columns under names that the operators use inside, rows without an id, and empty tables."""
    wide = docs.select("doc_id", "text", "lang", *[F.lit("x").alias(c) for c in CLASHES])
    plain = docs.select("doc_id", "text", "lang")
    y = spark.createDataFrame([(i, i % 2, i % 2, "x", 1) for i in range(40)], "doc_id long, quality int, toxic int, score string, o int")
    y0 = y.select("doc_id", "quality", "toxic")
    bench = spark.createDataFrame([(1, prose(30), 5)], "item_id long, text string, doc_id int")
    runs = {
        "op1": lambda d, y: suffix_dedup.suffix_dedup(d), "op5": lambda d, y: lm_score.lm_scores(d).select("doc_id", "held_out", "n_tokens", F.round("score", 6)), "op6": lambda d, y: simhash_dedup.simhash_groups(d),
        "op7": lambda d, y: quality_crf.quality_scores(d, y), "op8": lambda d, y: bpe_codec.bpe_digests(d), "op9": lambda d, y: toxicity_cnn.toxicity_scores(d, y), "op10": lambda d, y: decontaminate.contaminated(d, bench),
        "filter": lambda d, y: quality_crf.quality_filter(d, y).select("doc_id", "text"), "near": lambda d, y: simhash_dedup.near_dedup(d).select("doc_id", "text"), "repeats": lambda d, y: suffix_dedup.drop_repeats(d).select("doc_id", "text"), "leaks": lambda d, y: decontaminate.decontaminate(d, bench).select("doc_id", "text"),
    }
    for name, f in runs.items():
        got = sorted(str(tuple(r)) for r in f(wide, y).collect())
        assert got == sorted(str(tuple(r)) for r in f(plain, y0).collect()), name
        assert f(empty(wide), y).count() == 0, name
    for f in (quality_crf.quality_scores, toxicity_cnn.toxicity_scores):
        assert f(docs, y0).where("held_out is null").count() == 0 and not f(docs, y0).where("doc_id is null").first().held_out


def brute_pipeline(rows, bench):
    """The stages by definition, on (doc_id, text); without labels the first keeps all."""
    from tokenizers import Tokenizer

    sets = [set(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else set() for w in ((t or "").encode().lower().split() for _, t in rows)]
    near = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    comp = brute_components([d for d, _ in rows], near)
    seen, kept = set(), []
    for d, t in sorted(r for r in rows if comp[r[0]] == r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes().decode()
        if rest.strip(" ") or not gone.any():
            kept.append((d, rest))
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().lower())
    leaked = lambda t: any(naive_tiling(words(x), words(t), min(5, len(words(x))))[0] >= 0.8 * len(words(x)) for x in bench)
    tok, out = Tokenizer.from_file(bpe_codec.default_path()), []
    for d, t in kept:
        if not leaked(t):
            ids = tok.encode(t, add_special_tokens=False).ids
            out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out)


def test_pipeline_is_brute_force(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    base, item, passage = text(120), text(30), text(40)
    near = base.split()
    near[60] = "edited"
    half = item.split()
    rows = [(1, base), (2, " ".join(near)), (3, base.encode().upper().decode()), (4, text(50) + " " + passage + " " + text(20)), (5, passage + " " + text(30)), (6, passage), (7, " ".join(half[15:]) + " then " + " ".join(half[:15])), (8, text(10) + " " + item + " " + text(5)), (9, text(9)), (10, None), (11, ""), (12, "a b"), (13, "a b"), (14, " \n ")]
    rows += [(20 + i, text(rng.randint(1, 60)) + "\n" + text(8)) for i in range(20)]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), i) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, sid long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in p.run(spark, str(tmp_path)).collect())
    assert got == brute_pipeline(rows, [item])
    assert {d for d, *_ in got} >= {1, 4, 5, 9, 12} and not {d for d, *_ in got} & {2, 3, 6, 7, 13}


def test_pipeline_of_odd_rows(spark, docs, tmp_path):
    """Nulls, repeated ids, clashing names and an empty table go through all stages, which keep the columns."""
    import corpus_pipeline as p

    for name, df in (("odd", docs.withColumn("n_removed", F.lit(1)).withColumn("score", F.lit("z")).withColumn("key", F.lit(0))), ("none", empty(docs))):
        where = f"{tmp_path}/{name}"
        df.write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
        now = df
        for _, stage in p.STAGES[:-1]:
            now = stage(spark, now, where)
            assert now.columns == df.columns
        ids = sorted(str(r.doc_id) for r in now.collect())
        assert sorted(str(r.doc_id) for r in p.run(spark, where).collect()) == ids and ("None" in ids) == (name == "odd")


def test_tasks_of_repeats_hold_little():
    """What a task that sends groups holds at its peak, and what its worker keeps."""
    import tracemalloc

    import pyarrow as pa

    from covelake.llm import common, kernels

    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes().decode() for _ in range(8000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 1000), pa.int64()), pa.array(texts[i : i + 1000])], ["sid", "text"]) for i in range(0, 8000, 1000)]
    tracemalloc.start()
    n = sum(len(b) for b in common.lean(suffix_dedup.send_groups(8, 100, np.zeros(0, np.uint64)))(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert n and peak < 65 and not kernels._powers


def test_near_groups_come_through_the_operators_links(spark, monkeypatch):
    """What meets first are texts of equal fingerprints and those that op6 links; later only members of different groups meet."""
    rng = random.Random(3)
    rows = []
    for _ in range(30):
        base = [rng.choice(WORDS) for _ in range(400)]
        for n in (0, 1, 1, 2, 8):
            text = list(base)
            for i in rng.sample(range(400), n):
                text[i] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(text)))
    met, scored = [], simhash_dedup._scored

    def spy(found, classes, least):
        met.append({(r.a, r.b) for r in found.select("a", "b").collect()})
        return scored(found, classes, least)

    monkeypatch.setattr(simhash_dedup, "_scored", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash_dedup.near_dedup(df).collect()}
    fp = {i: simhash_dedup.fingerprint(t.encode()) for i, t in rows}
    first = {}
    for i, _ in rows:
        first.setdefault(fp[i], i)
    firsts = sorted(first.values())
    want = {(a, b) for a in firsts for b in firsts if a < b and (fp[a] ^ fp[b]).bit_count() <= 2} | {(first[fp[i]], i) for i, _ in rows if first[fp[i]] != i}
    assert want and met[0] == want
    grouped = brute_components([i for i, _ in rows], want)  # all of these pairs are near copies
    assert met[1] and all(grouped[a] != grouped[b] for a, b in met[1])
    assert kept == {i for i, _ in rows if i % 5 == 0}
