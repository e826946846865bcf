"""Main text of web pages.

A tolerant tokenizer, linear in the page, cuts a page into blocks and places each: ``main`` (inside article or main),
``skip`` (menus, page headers, footers, sidebars, notices, adverts, forms, comments, by element or by the words of
class, id and role), ``maybe`` (an article inside something that only such words call boilerplate), or ``open``.

The host judges what markup doesn't, by a suffix array of its pages' token streams. Each task takes the streams of its
pages together, host by host, and sorts their suffixes by their first ``RUN`` tokens (prefix doubling); suffixes that agree in
them are a class, and neighbouring classes make the longer substrings. Classes travel with the least and the greatest
content they stand on, so a hot host is no hot key, and those on two pages with distinct contents are repeated (copies of
a page count once).

* Pages without main text yield their open blocks without the blocks that repeated substrings cover wholly, and without
  covered runs at blocks' edges; unique runs stay. If that leaves nothing, they yield their ``maybe`` blocks.
* Blocks of main text are judged whole: one that stands on ``SHARE`` of the host's distinct pages, and on ``COPIES`` at
  least, is part of the site and goes. Rarer repetition stays: articles quote and copy each other.

Edge cases: null and empty html yield an empty text; pages of any length are read whole; unclosed elements end with
their parent; a quote that never closes ends with its tag; repeated page_ids give a row each; pages without a host form one
of their own; an empty table yields no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import lean, materialise, small_batches

#: Tokens of a repeated run.
RUN = 8
#: Share and number of a host's distinct pages from which on a block of main text belongs to the site.
SHARE, COPIES = 0.8, 8
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: Up to a tag's end; quotes count after an equals sign only.
_REST = re.compile(r"""(?>[^>=]|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+>""")
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template svg iframe xmp noembed noframes".split())
_SKIP = frozenset("nav footer aside form button select option dialog menu head object canvas audio video label fieldset".split())
_HEAD = frozenset("head title meta link script style base noscript template basefont bgsound noframes".split())
_BLOCK = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption blockquote pre section article main header footer nav aside figure figcaption address details summary form hr body html fieldset".split()
)
_CLOSES_P = _BLOCK - {"body", "html"}
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead share sharing social related recommended "
    "recommendations widget widgets login signup register toolbar tags skip contentinfo complementary dialog form".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Whole names only: in others the word tells what a page is about.
_SEARCH = frozenset("search searchform searchbox searchbar search-form search-box search-bar site-search".split())
#: First words of names that say what a page or wrapper has or is filed under.
_ABOUT = frozenset("with without has no is not tag category cat topic post page type format layout js".split())
_WORDS = re.compile(r"[A-Za-z]+|\d+")


def _named(name: str, value: str) -> str:
    """skip (comments), soft (other boilerplate) or nothing, by the names in a class, id or role."""
    found = ""
    for one in value.split():
        words = _WORDS.findall(one)
        if not words or words[0] in _ABOUT:
            continue
        if name == "article":
            words = words[:1]  # articles are filed under many names
        if any(w in _COMMENTS for w in words):
            return "skip"
        if one in _SEARCH or any(w in _HINTS for w in words):
            found = "soft"
    return found


def _hinted(name: str, attrs: str) -> tuple[str, bool]:
    """(skip, soft or nothing; main) by attributes."""
    skip, main = "", False
    if attrs and ("=" in attrs or "hidden" in attrs):
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                skip = "skip"
            elif key == "itemprop":
                main |= value == "articlebody"
            elif key == "role" and value == "main":
                main = True
            elif key in ("class", "id", "role") and name not in ("html", "body", "main"):
                skip = max(skip, _named(name, value), key=("", "soft", "skip").index)
    return skip, main


def tags(page: str):
    """(text before, end tag?, element, attributes) of all tags in order, the last with element None. Raw elements come whole.

    Every search that fails is not tried again, so the time is linear in the page.
    """
    at = start = 0
    n, quotes = len(page), True
    missing: set[str] = set()

    def find(what: str, begin: int) -> int:
        k = -1 if what in missing else page.find(what, begin)
        if k < 0:
            missing.add(what)
        return k

    while True:
        at = find("<", at)
        if at < 0:
            break
        if page.startswith(("<!", "<?"), at):
            if page.startswith("<!--", at):
                end = find("-->", at + 4)
                after = end + 3 if end >= 0 else n
            elif page.startswith("<![CDATA[", at) and (end := find("]]>", at)) >= 0:
                after = end + 3
            else:
                end = find(">", at)
                after = end + 1 if end >= 0 else 0
            if not after:
                at += 1
                continue
            yield page[start:at], False, "", ""
            at = start = after
            continue
        close = page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + close)
        if name is None:
            at += 1
            continue
        m = _REST.match(page, name.end()) if quotes else None
        if m is None:
            quotes = False  # a quote that never closes: from here on tags end at the next bracket
            end = find(">", name.end())
            if end < 0:
                at += 1
                continue
            end += 1
        else:
            end = m.end()
        element, attrs = name[0].lower(), page[name.end() : end - 1]
        before, at = page[start:at], end
        start = end
        if element in _RAW and not close:
            key = "</" + element
            stop = None if key in missing else re.compile(rf"</{re.escape(element)}\s*+>", re.I).search(page, at)
            if stop is None:
                missing.add(key)
            if stop or element not in ("xmp", "noembed", "noframes"):
                at = start = stop.end() if stop else n
        yield before, close, element, attrs
    yield page[start:], False, None, ""


def blocks(page: str) -> list[tuple[str, str]]:
    """(zone, text) of all non-empty blocks in page order."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # (element, zone inside it)
    marks: list[int] = []  # where block elements stand in the stack
    opened: dict[str, list[int]] = {}  # where each element stands in the stack
    zone = "open"

    def flush():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(("skip" if zone == "soft" else zone, text))
            held.clear()

    def cut(depth: int):
        nonlocal zone
        for name, _ in stack[depth:]:
            opened[name].pop()
        del stack[depth:]
        while marks and marks[-1] >= depth:
            marks.pop()
        zone = stack[-1][1] if stack else "open"

    for before, close, name, attrs in tags(page):
        if before:
            held.append(before)
        if not name:
            continue
        if name == "br":
            held.append(" ")
            continue
        if close:
            depth = opened[name][-1] if opened.get(name) else None
            if name in _BLOCK or depth is not None and (stack[depth - 1][1] if depth else "open") != zone:
                flush()
            if depth is not None:
                cut(depth)
            continue
        if opened.get("head") and name not in _HEAD:  # the end tag of head may be left out
            flush()
            cut(opened["head"][-1])
        if name in _RAW:
            held.append(" " if name not in ("script", "style") else "")
            continue
        if name in _BLOCK:
            flush()
        if name in _VOID:
            continue
        if name in _CLOSES_P:
            while marks and stack[marks[-1]][0] == "p":  # an open paragraph ends here
                cut(marks[-1])
            if name == "li" and marks and stack[marks[-1]][0] == "li":
                cut(marks[-1])
        skip, main = _hinted(name, attrs)
        article = not skip and (main or name in ("article", "main"))
        inner = zone
        if zone == "soft":
            inner = "maybe" if article else "skip" if skip == "skip" or name in _SKIP else "soft"
        elif zone != "skip":
            if skip or name in _SKIP or (name == "header" and zone == "open"):
                inner = "soft" if skip == "soft" and name not in _SKIP else "skip"
            elif article and zone != "maybe":
                inner = "main"
        if inner != zone:
            flush()
        if not attrs.endswith("/"):
            opened.setdefault(name, []).append(len(stack))
            if name in _BLOCK:
                marks.append(len(stack))
            stack.append((name, inner))
            zone = inner
    flush()
    return out


def _host(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return (m[1].rpartition("@")[2].partition(":")[0] if m else "").lower()


def suffix_classes(streams: list[list[str]], hosts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, page, place) of all suffixes of ``RUN`` tokens and more, in the order of the suffix array; a shorter stream is one suffix.

    Suffixes of one host that agree in ``RUN`` tokens have one class. Ranks by 1, 2, 4, ... tokens come by doubling.
    """
    size = np.array([len(s) for s in streams], np.int64)
    ends = np.cumsum(size)
    page = np.repeat(np.arange(len(streams)), size)
    if not len(page):
        return page, page, page
    ids: dict = {}
    rank = np.fromiter((ids.setdefault((h, t), len(ids)) for h, s in zip(hosts, streams, strict=True) for t in s), np.int64, len(page))
    left = ends[page] - np.arange(len(page))  # tokens to the page's end
    done = 1
    while done < RUN:
        step = min(done, RUN - done)
        # the rank from `step` tokens on, or 0 where the page has ended
        later = np.where(left > step, rank[np.minimum(np.arange(len(page)) + step, len(page) - 1)] + 1, 0)
        rank = np.unique(rank * (len(page) + len(ids) + 2) + later, return_inverse=True)[1]
        done += step
    place = size[page] - left
    at = np.flatnonzero((left >= RUN) | (place == 0))
    at = at[np.argsort(rank[at], kind="stable")]
    return rank[at], page[at], place[at]


PARSED = "rid long, page_id long, url string, main array<string>, rest array<string>, maybe string, prints array<long>, host long, content long, kind int, print long, lo long, hi long"
PAGE, RUNS, BLOCKS = range(3)


def _parse(batches):
    import xxhash

    rid = TaskContext.get().partitionId() << 36
    key = lambda x: xxhash.xxh64_intdigest(x, 17) - (1 << 63)
    names = [f.split()[0] for f in PARSED.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    kinds = [kinds[f.split()[1]] for f in PARSED.split(", ")]

    def rows(**cols):
        n = len(next(iter(cols.values())))
        return pa.RecordBatch.from_arrays([pa.array(cols[c], k) if c in cols else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

    for batch in batches:
        n = len(batch)
        url = batch.column(1).to_pylist()
        hosts, streams, mains, rests, maybes = [_host(u) for u in url], [], [], [], []
        for page in batch.column(2).to_pylist():
            got = blocks(page or "")
            main = [t for z, t in got if z == "main"]
            mains.append(main or None)
            rests.append(None if main else [t for z, t in got if z == "open"])
            maybes.append("\n".join(t for z, t in got if z == "maybe") or None)
            streams.append(" ".join(t for z, t in got if (z != "main" if main else z == "open")).split())
        content = np.array([key(f"{h}\0" + ("\0".join(m) if m else " ".join(s))) for h, m, s in zip(hosts, mains, streams, strict=True)], np.int64)
        cls, page, place = suffix_classes(streams, hosts)
        first = np.flatnonzero(np.append(True, np.diff(cls) != 0)) if len(cls) else np.zeros(0, np.int64)
        prints = np.array([key(f"{hosts[p]}\0" + " ".join(streams[p][a : a + RUN])) for p, a in zip(page[first].tolist(), place[first].tolist(), strict=True)], np.int64)
        own: list = [None if m else [0] * max(1, len(s) - RUN + 1) if s else [] for m, s in zip(mains, streams, strict=True)]
        for p, a, x in zip(page.tolist(), place.tolist(), prints[np.cumsum(np.append(False, np.diff(cls) != 0)) if len(cls) else cls].tolist(), strict=True):
            if own[p] is not None:
                own[p][a] = x
        yield rows(rid=list(range(rid, rid + n)), page_id=batch.column(0), url=url, main=mains, rest=rests, maybe=maybes, prints=own, host=[key(h) for h in hosts], content=content, kind=[PAGE] * n)
        rid += n
        if len(first):
            yield rows(kind=[RUNS] * len(first), print=prints, lo=np.minimum.reduceat(content[page], first), hi=np.maximum.reduceat(content[page], first))
        seen = {(key(f"{h}\1{t}"), c) for h, m, c in zip(hosts, mains, content.tolist(), strict=True) for t in m or ()}
        if seen:
            a, b = zip(*seen, strict=True)
            yield rows(kind=[BLOCKS] * len(a), print=a, content=b, host=[0] * len(a))


def keep_unique(text_blocks: list[str], repeated: set[int]) -> str:
    """Blocks without the runs that ``repeated`` (starts of repeated runs in the page's stream) cover at their edges or wholly."""
    parts = [t.split() for t in text_blocks]
    stream = [w for part in parts for w in part]
    covered = [False] * len(stream)
    for i in repeated:
        for k in range(i, min(i + RUN, len(stream))):
            covered[k] = True
    out, b = [], 0
    for part in parts:
        a, b = b, b + len(part)
        e = b
        while a < e and covered[a]:
            a += 1
        while a < e and covered[e - 1]:
            e -= 1
        if a < e:
            out.append(" ".join(stream[a:e]))
    return "\n".join(out)


def _finish(batches):
    for batch in batches:
        text = []
        for main, rest, maybe, hits in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5, 6)), strict=True):
            gone = set(hits or [])
            text.append("\n".join(t for i, t in enumerate(main) if i not in gone) if main else keep_unique(rest or [], gone) or maybe or "")
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])


def _block_prints(batches):
    import xxhash

    for batch in batches:
        rid, at, prints = [], [], []
        for r, u, main in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h = _host(u)
            for i, t in enumerate(main):
                rid.append(r)
                at.append(i)
                prints.append(xxhash.xxh64_intdigest(f"{h}\1{t}", 17) - (1 << 63))
        yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(at, pa.int32()), pa.array(prints, pa.int64())], ["rid", "at", "print"])


def main_texts(pages: DataFrame, by_host: bool = True) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages(page_id, url, html)``; without ``by_host`` markup alone decides."""
    small_batches(pages.sparkSession)
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = materialise(base.mapInArrow(lean(_parse), PARSED), "parsed")
    one = parsed.where(f"kind = {PAGE}")
    told = ("rid", "page_id", "url", "main", "rest", "maybe")
    schema = "page_id long, url string, text string, n_chars long"
    if not by_host:
        return one.select(*told, F.lit(None).cast("array<int>").alias("hits")).mapInArrow(lean(_finish), schema)
    runs = parsed.where(f"kind = {RUNS}").groupBy("print").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("print")
    open_hits = one.where("main is null").select("rid", F.posexplode("prints").alias("at", "print")).join(runs, "print").select("rid", "at")
    # a block's distinct pages against those of its host, of which there are COPIES at least
    many = parsed.where(f"kind = {BLOCKS}").select("print", "content").distinct().groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("content")).where(f"n >= {COPIES}")
    size = one.where("main is not null").select("host", "content").distinct()
    hosts = size.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    of = materialise(many.join(size, "content").join(hosts, "host").where(F.col("n") >= F.col("pages") * SHARE).select("print"), "site_blocks")
    if of.isEmpty():
        hits = open_hits
        whole = one.where("main is not null").select(*told, F.lit(None).cast("array<int>").alias("hits"))
    else:
        found = one.where("main is not null").select("rid", "url", "main").mapInArrow(lean(_block_prints), "rid long, at int, print long")
        hits = open_hits.union(found.join(of, "print", "left_semi").select("rid", "at"))
        whole = None
    hits = hits.groupBy("rid").agg(F.collect_list("at").alias("hits"))
    judged = (one.where("main is null") if whole is not None else one).select(*told).join(hits, "rid", "left").select(*told, "hits")
    return (judged if whole is None else whole.union(judged)).mapInArrow(lean(_finish), schema)
