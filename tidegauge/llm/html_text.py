"""Main text of web pages: markup first, then a suffix array over each host's pages.

A page is cut into blocks. Markup says of many whether they are the article
(article, main) or something else (nav, aside, footer, forms, and elements whose
class or id names adverts, menus, comments and the like). Where markup says
neither, also beside a marked article, the host's other pages do: their token streams are concatenated, the
suffixes are sorted, and runs of at least RUN_TOKENS tokens that many distinct
pages share are boilerplate; a block stays if most of it is in unique runs.

What an article repeats from other pages (quotations, standing lines) is its
text, so nothing is taken out of a marked article.

Pages of a host are dealt into groups of about GROUP_BYTES by a hash, so a host of
any size is as many tasks as it needs. What counts as shared does not depend on
the groups or on the size of the host: a run is shared that SHARED_PAGES pages of
the whole host hold. Where a host has several groups and blocks that markup leaves
open, the hashes of all its runs are counted over its pages by a shuffle, and each
group gets those of its own that are shared.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of

SCHEMA = "page_id long, url string, text string, n_chars long"
RUN_TOKENS = 8
SHARED_PAGES = 3
GROUP_BYTES = 4 << 20
#: Hosts beyond this many are joined by a shuffle; fewer are broadcast.
BROADCAST_HOSTS = 200_000

OTHER, OPEN, ARTICLE, TOP = 0, 1, 2, 3  # TOP: the header of an article, of which headings are its text
_RAW = "script|style|noscript|template|textarea|title"
#: Left out with all that they hold, without ending the block around them, if they are closed.
_WIDGETS = frozenset("svg iframe object select button math canvas".split())
_WIDGET = re.compile(rf"""<(/?)({"|".join(sorted(_WIDGETS))})\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.I)
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)|"
    r"""<(/?)([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[a-z/!?][^>]*+(?:>|\Z)""",
    re.I | re.S,
)
_HINT = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*["']?([^"'>]*)""", re.I)
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|adsense|banner|promo|promotion|sponsor(?:ed)?|sidebar|menu|nav|navbar|navigation|breadcrumbs?|comments?|"
    r"replies|disqus|respond|cookies?|consent|notice|alert|newsletter|subscribe|share|sharing|social|related|recommended|footer|header|masthead|popup|modal|overlay|pagination|pager|login|signup|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CHROME = frozenset("head nav aside footer form dialog menu".split())
_BODY = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _zone(name: str, attributes: str, above: int) -> int:
    """The zone inside an element, from the zone around it."""
    if name in _CHROME or above == OTHER:
        return OTHER
    if above == TOP:
        return ARTICLE if name in _HEADINGS else TOP
    if name == "header":
        return TOP if above == ARTICLE else OTHER
    hints = " ".join(_HINT.findall(attributes)) if "=" in attributes else ""
    if hints and name not in ("html", "body") and _NOISE.search(hints):
        return OTHER
    return ARTICLE if name in _BODY or above == ARTICLE else OPEN


def closed_widgets(page: str) -> dict[int, int]:
    """Where each widget with an end tag of its own starts and ends; others hold nothing.

    Drawings, formulas and objects nest; of the others a second one leaves the first without an end.
    """
    found: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    for m in _WIDGET.finditer(page):
        own = begun.setdefault(m[2].lower(), [])
        if not m[1] and not m[3].endswith("/"):
            if m[2].lower() not in ("svg", "math", "object"):
                own.clear()
            own.append(m.start())
        elif m[1] and own:
            found[own.pop()] = m.end()
    return found


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of a page's non-empty blocks, in order; white space is one space and references are decoded.

    A widget (button, select, drawing and the like) that closes itself, or that nothing closes, holds no text.
    """
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}  # where in the stack each name is
    widgets = closed_widgets(page)
    parts: list[str] = []
    zone, at = OPEN, 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text and zone in (OPEN, ARTICLE):
            out.append((zone, text))
        parts.clear()

    def close(place: int) -> int:
        """The zone around the element at a place of the stack, which ends with all in it."""
        around = stack[place][1]
        while len(stack) > place:
            places[stack.pop()[0]].pop()
        return around

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue  # within a widget
        parts.append(page[at : m.start()])
        at = m.end()
        name = m[3].lower() if m[3] else ""
        if name in _WIDGETS:
            at = widgets.get(m.start(), at)
            continue
        if name == "br":
            parts.append(" ")
        if not name or name in _INLINE:
            hidden = name and not m[2] and name not in _VOID and "=" in m[4] and _zone(name, m[4], zone) != zone
            if not hidden and not (m[2] and stack and stack[-1][0] == name):
                continue
        flush()
        if m[2]:
            open_ = places.get(name)
            if open_ and (name not in ("p", "li") or open_[-1] == len(stack) - 1):
                zone = close(open_[-1])
        elif name and name not in _VOID and not m[4].endswith("/"):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                zone = close(len(stack) - 1)  # an open paragraph or item ends where the next begins
            elif name not in ("p",) and stack and stack[-1][0] == "p" and name not in _INLINE:
                zone = close(len(stack) - 1)
            places.setdefault(name, []).append(len(stack))
            stack.append((name, zone))
            zone = _zone(name, m[4], zone)
    parts.append(page[at:])
    flush()
    return out


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The rank of every suffix among all by its first `depth` tokens, by prefix doubling; equal beginnings share a rank.

    Suffixes shorter than `depth` must be told apart by the tokens themselves, as a unique last token does.
    """
    _, ranks = np.unique(tokens, return_inverse=True)
    known = 1
    while known < depth:
        step = min(known, depth - known)
        ahead = np.full(len(ranks), -1, np.int64)
        ahead[: max(0, len(ranks) - step)] = ranks[step:]
        _, ranks = np.unique(ranks.astype(np.int64) * (len(ranks) + 1) + ahead + 1, return_inverse=True)
        known += step
    return ranks


def shared_runs(pages: list[list[int]], least: int, depth: int = RUN_TOKENS) -> list[np.ndarray]:
    """Per page, which tokens are in runs of `depth` tokens or more that at least `least` distinct pages hold."""
    sizes = np.array([len(p) for p in pages])
    at = np.cumsum([0, *(sizes + 1)])
    stream = np.empty(at[-1], np.int64)
    for k, tokens in enumerate(pages):
        stream[at[k] : at[k + 1] - 1] = tokens
        stream[at[k + 1] - 1] = -1 - k  # ends of pages are unlike any token
    of = np.repeat(np.arange(len(pages)), sizes + 1)
    ranks = suffix_ranks(stream, depth)
    pairs = np.unique(ranks * np.int64(len(pages)) + of)
    holders = np.bincount(pairs // len(pages), minlength=int(ranks.max()) + 1 if len(ranks) else 0)
    shared = holders[ranks] >= least
    change = np.zeros(len(stream) + depth + 1, np.int64)
    np.add.at(change, np.flatnonzero(shared), 1)
    np.add.at(change, np.flatnonzero(shared) + depth, -1)
    covered = np.cumsum(change)[: len(stream)] > 0
    return [covered[at[k] : at[k + 1] - 1] for k in range(len(pages))]


_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(RUN_TOKENS)], np.uint64)


def run_hashes(texts: list[str], known: dict[str, int]) -> np.ndarray:
    """64-bit hashes of every run of RUN_TOKENS tokens of a page's blocks, in order; `known` keeps hashes of tokens."""
    words = [w for text in texts for w in text.split()]
    for w in words:
        if w not in known:
            known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    values = np.array([known[w] for w in words], np.uint64)
    count = max(0, len(values) - RUN_TOKENS + 1)
    out = np.zeros(count, np.uint64)
    for k, factor in enumerate(_FACTORS):
        out += values[k : k + count] * factor
    return (out ^ out >> np.uint64(32)).view(np.int64)


def covered_by(page: np.ndarray, shared: np.ndarray, size: int) -> np.ndarray:
    """Which of a page's `size` tokens are in runs whose hashes are among the sorted shared ones."""
    change = np.zeros(size + RUN_TOKENS + 1, np.int64)
    places = np.flatnonzero(np.isin(page, shared))
    np.add.at(change, places, 1)
    np.add.at(change, places + RUN_TOKENS, -1)
    return np.cumsum(change)[:size] > 0


def main_texts(pages: list[list[tuple[int, str]]], shared: np.ndarray | None = None) -> list[str]:
    """The main text of each page of one host, from its blocks.

    `shared`: hashes of runs that the whole host shares, if these are not all of its pages.
    """
    numbers: dict[str, int] = {}
    streams, borders = [], []
    for page in pages:
        own, ends = [], [0]
        for _, text in page:
            own += [numbers.setdefault(w, len(numbers)) for w in text.split()]
            ends.append(len(own))
        streams.append(own)
        borders.append(ends)
    if not any(zone == OPEN for page in pages for zone, _ in page):
        covered = [np.zeros(len(s), bool) for s in streams]  # nothing is left to decide
    elif shared is not None:
        known: dict[str, int] = {}
        covered = [covered_by(run_hashes([t for _, t in page], known), shared, len(s)) for page, s in zip(pages, streams, strict=True)]
    else:
        covered = shared_runs(streams, SHARED_PAGES)
    out = []
    for page, ends, marks in zip(pages, borders, covered, strict=True):
        kept = []
        for (zone, text), a, b in zip(page, ends, ends[1:], strict=False):
            if zone == ARTICLE or 2 * int(marks[a:b].sum()) <= b - a:
                kept.append(text)
        out.append("\n\n".join(kept))
    return out


def host_of(url: Column) -> Column:
    """The lower-case host of a web address without port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html, or one without text, gives the empty text; a null url
    is a host of its own; repeated rows give repeated results and count as pages.
    """
    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    hosts = given.groupBy("host").agg(F.ceil(F.sum(F.octet_length("html")) / GROUP_BYTES).cast("int").alias("groups")).filter("groups > 1")
    few = hosts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    dealt = given.join(F.broadcast(hosts) if few else hosts, "host", "left")
    group = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("groups", F.lit(1))).cast("int")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [blocks(page) for page in texts_of(batch, "html").to_pylist()]
            zones = pa.array([[z for z, _ in own] for own in found], pa.list_(pa.int32()))
            texts = pa.array([[t for _, t in own] for own in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "part")), zones, texts], names=["page_id", "url", "host", "part", "zones", "texts"])

    def decided(table: pa.Table, shared: np.ndarray | None) -> pa.Table:
        own = [list(zip(z, t, strict=True)) for z, t in zip(table["zones"].to_pylist(), table["texts"].to_pylist(), strict=True)]
        texts = main_texts(own, shared)
        return pa.table({"page_id": table["page_id"], "url": table["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            for host, part, zones, texts in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "zones", "texts")), strict=True):
                hashes = run_hashes(texts, known)
                ends = np.cumsum([0, *(len(t.split()) for t in texts)])
                asked = np.zeros(ends[-1] + 1, bool)
                for zone, a, b in zip(zones, ends, ends[1:], strict=False):
                    asked[max(0, a - RUN_TOKENS + 1) : b] |= zone == OPEN  # runs that touch an open block
                found, first = np.unique(hashes, return_inverse=True)
                touches = np.bincount(first, weights=asked[: len(hashes)], minlength=len(found)) > 0
                names = ["host", "part", "run", "asked"]
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(found), pa.string()), pa.array([part] * len(found), pa.int32()), pa.array(found, pa.int64()), pa.array(touches, pa.bool_())], names=names)

    def decide(table: pa.Table) -> pa.Table:
        return decided(table, None)

    def decide_group(table: pa.Table, shared: pa.Table) -> pa.Table:
        return decided(table, np.sort(shared["run"].to_numpy()))

    parsed = dealt.select("page_id", "url", "html", "host", "groups", group.alias("part"))
    shape = "page_id long, url string, host string, part int, zones array<int>, texts array<string>"
    small = parsed.filter("groups IS NULL").drop("groups").mapInArrow(parse, shape)
    large = parsed.filter("groups IS NOT NULL").drop("groups").mapInArrow(parse, shape)
    alone = parsed.drop("groups").mapInArrow(parse, shape).groupBy("host", "part").applyInArrow(decide, SCHEMA)
    is_open = F.exists("zones", lambda z: z == OPEN)
    # Without open blocks on a host of several groups, no group needs to know of another.
    if hosts.isEmpty() or large.filter(is_open).isEmpty():
        return alone
    counted = large.join(large.filter(is_open).select("host").distinct(), "host", "left_semi").mapInArrow(runs, "host string, part int, run long, asked boolean")
    shared = counted.groupBy("host", "run").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= SHARED_PAGES).select("host", "run")
    asked = counted.filter("asked").select("host", "part", "run").distinct().join(shared, ["host", "run"])
    together = large.groupBy("host", "part").cogroup(asked.groupBy("host", "part")).applyInArrow(decide_group, SCHEMA)
    return small.groupBy("host", "part").applyInArrow(decide, SCHEMA).unionByName(together)
