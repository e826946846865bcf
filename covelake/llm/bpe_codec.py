"""Byte-level BPE encoding by speculation, and decoding.

Every text is cut into words by the tokenizer's pattern. For words not met before, a greedy
longest-match proposes tokens; one vectorised pass tests all adjacent proposed pairs of all those
words; a word keeps its proposal if every token is its own encoding and every pair is compatible
(no merge across the boundary would have come first). Only the other words go through exact merging.

Edge cases: null and empty texts give no tokens (hashes of the empty string). A special token's
string inside a text is that token, as in the public library's default. Rows are kept one to one,
repeated doc_ids included; extra columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covelake.llm.common import kept_caches, lean, small_batches

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Words kept in a worker's cache; beyond this it starts anew.
CACHE_WORDS = 500_000
#: Bytes of texts whose new words are encoded together, and length of a word from which merging keeps a heap.
SLICE, LONG_WORD = 1 << 20, 48
#: Rank of pairs that don't merge.
NEVER = 1 << 60
#: The public pattern of this vocabulary family, with its blanks spelt out (fixed value).
_S = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        alphabet = _byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        self.id_of = {}
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = raw(token)
                self.id_of[self.bytes_of[i]] = i
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        n = len(self.bytes_of)
        #: longest token that begins with three bytes
        self.longest: dict[bytes, int] = {}
        for token in self.id_of:
            if len(token) > 2:
                self.longest[token[:3]] = max(len(token), self.longest.get(token[:3], 0))
        self.id_of_byte = [self.id_of.get(bytes([b]), -1) for b in range(256)]
        self.written = [str(i) for i in range(n)]
        #: rank of the merge that makes a token (-1: none), and its two parts
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank_of: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            c = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.merge[a, b] = (r, c)
            self.rank_of[a, b] = r
            self.made.append(c)
            if self.rank[c] < 0:
                self.rank[c], self.left[c], self.right[c] = r, a, b
        keys = np.array([a << 32 | b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.sound: dict[int, bool] = {}
        self.words = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.cache: dict[str, tuple[str, int, str]] = {}

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, i, n, get, longest = [], 0, len(word), self.id_of.get, self.longest.get
        while i < n:
            for j in range(min(n, i + longest(word[i : i + 3], 2)), i, -1):
                t = get(word[i:j])
                if t is not None:
                    out.append(t)
                    i = j
                    break
        return out

    def exact(self, word: bytes) -> list[int]:
        """Merging by rank, leftmost first; a heap over a linked list keeps very long words near linear."""
        if len(word) < LONG_WORD:
            short, get, made = [self.id_of_byte[x] for x in word], self.rank_of.get, self.made
            ranks = [get(pair, NEVER) for pair in zip(short, short[1:])]
            while ranks and (r := min(ranks)) < NEVER:
                i = ranks.index(r)
                short[i] = made[r]
                del short[i + 1], ranks[i]
                if i < len(ranks):
                    ranks[i] = get((short[i], short[i + 1]), NEVER)
                if i:
                    ranks[i - 1] = get((short[i - 1], short[i]), NEVER)
            return short
        ids: list[int | None] = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = c, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := self.merge.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [x for x in ids if x is not None]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For every pair: would a and b, each whole in isolation, stay apart when side by side?

        They would not if some part x at the right edge of a and some part y at the left edge of b
        merge with rank m while both are current: made before m, and not yet taken up by their parents
        (on equal rank the leftmost merge goes first).
        """
        ok = np.ones(len(a), bool)
        x, until_x = a.copy(), np.full(len(a), np.iinfo(np.int64).max)
        while (live := x >= 0).any():
            y, until_y = b.copy(), np.full(len(b), np.iinfo(np.int64).max)
            while (on := live & (y >= 0)).any():
                key = (x << 32) | y
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                m = np.where(on & (self.pair_keys[at] == key), self.pair_ranks[at], -1)
                ok &= ~((m >= 0) & (m > self.rank[x]) & (m > self.rank[y]) & (m < until_x) & (m <= until_y))
                y, until_y = np.where(on, self.left[y], -1), np.where(on, self.rank[y], until_y)
            x, until_x = np.where(live, self.right[x], -1), np.where(live, self.rank[x], until_x)
        return ok

    def is_sound(self, token: int) -> bool:
        """Is the token the encoding of its own bytes?"""
        if token not in self.sound:
            self.sound[token] = self.exact(self.bytes_of[token]) == [token]
        return self.sound[token]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        proposed = [self.propose(w) for w in words]
        size = np.array([len(p) for p in proposed], np.int64)
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(words)), size)
        good = np.ones(len(words), bool)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inner):
            pairs, back = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
            bad = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
            good[owner[inner[bad]]] = False
        unsound = [t for t in np.unique(flat).tolist() if not self.is_sound(t)]
        if unsound:
            good[owner[np.isin(flat, unsound)]] = False
        return [p if g else self.exact(w) for p, g, w in zip(proposed, good.tolist(), words, strict=True)]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.cache]
        bytes_of, written, cache = self.bytes_of, self.written, self.cache
        for w, ids in zip(new, self.encode_words([w.encode("utf-8") for w in new]), strict=True):
            back = b"".join([bytes_of[i] for i in ids]).decode("utf-8", errors="replace")
            cache[w] = (",".join([written[i] for i in ids]), len(ids), w if back == w else back)  # one string serves as key and value

    def parts(self, text: str) -> list:
        """The text as runs of words (lists) and special tokens (strings) in turn."""
        cut = self.cut(text) if self.cut and any(s in text for s in self.special) else (text,)
        return [part if k % 2 else self.words(part) for k, part in enumerate(cut)]

    def digest(self, parts: list) -> tuple[int, str, str]:
        ids, n, out = [], 0, []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(str(self.special[part]))
                out.append(part)
                n += 1
            elif part:
                a, b, c = zip(*[self.cache[w] for w in part], strict=True)
                ids.extend(a)
                n += sum(b)
                out.extend(c)
        return n, hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256("".join(out).encode("utf-8")).hexdigest()

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of all texts, about SLICE characters at a time: new words of a slice are encoded together."""
        out, i = [], 0
        while i < len(texts):
            held, size = [], 0
            while i < len(texts) and (not held or size + len(texts[i]) <= SLICE):
                held.append(self.parts(texts[i]))
                size += len(texts[i])
                i += 1
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            self.learn(set().union(*(part for parts in held for part in parts[::2])))
            out += [self.digest(parts) for parts in held]
        return out

    def encode(self, text: str) -> list[int]:
        parts = self.cut(text) if self.cut and text else [text]
        return [t for k, p in enumerate(parts) for t in ([self.special[p]] if k % 2 else [i for ids in self.encode_words([w.encode() for w in self.words(p)]) for i in ids])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: token count, digest of the ids, digest of the decoded text. No shuffle.

    ``tokenizer_path`` must be readable on every executor (it is part of an installed package); None
    takes the 50k byte-level vocabulary there.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        c = codec(tokenizer_path or default_path())
        kept_caches["bpe"] = codec.cache_clear
        for batch in batches:
            got = c.digests([t or "" for t in batch.column(1).to_pylist()])
            n, ids, decoded = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(run, keeps="bpe"), SCHEMA)
