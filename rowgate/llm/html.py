"""Main text of web pages: structure first, then a suffix array over each host's pages.

A page becomes a row of text blocks, each in the article, in boilerplate by its markup, or open.
The token streams of a host's pages, without their articles, are joined and their suffixes sorted; runs of
tokens that stand in several different pages are boilerplate, and are cut out of open blocks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from html import unescape
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import binaries, staging_for
from rowgate.llm.urlfilter import host_and_path
from rowgate.staging import Staging

OPEN, ARTICLE, BOILERPLATE, OUTSIDE = "o", "a", "b", "x"
RUN = 8
PAGES = 3
GROUP_BYTES = 4 << 20
MOST_HOT = 50_000
CUT = "\x1e"
# A fixed value: the odd multiplier of window hashes.
WINDOW_MIX = np.uint64(0x9E3779B97F4A7C15)

TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
NEVER_TEXT = frozenset(
    "aside button canvas datalist dialog footer form head header menu nav noscript object option search select svg "
    "template audio video math-input".split()
)
SAME_ENDS = {
    "li": frozenset(("ul", "ol", "menu")),
    "dt": frozenset(("dl",)),
    "dd": frozenset(("dl",)),
    "option": frozenset(("select",)),
    "tr": frozenset(("table",)),
    "td": frozenset(("tr", "table")),
    "th": frozenset(("tr", "table")),
}
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
HINTED = frozenset("div section ul ol dl li p span table td aside details figure a small strong em ins center".split())
HINTS = frozenset(
    "ad adbox ads adsense adslot adunit agegate alert alerts banner banners consent copyright disclaimer discussion "
    "disqus dropdown feedback gdpr hamburger legal login modal notice notices notification outbrain overlay pager "
    "pagination paywall popup promo promos promotion rail recommended related rss search share sharing shares sharebar "
    "side signin signup sitemap social submenu subnav subscribe subscription taboola teaser teasers toolbar topbar topnav "
    "trending warning widget widgets".split()
)
HINT_STARTS = (
    "advert", "breadcrumb", "comment", "cookie", "footer", "header", "masthead", "menu", "nav", "newsletter", "replies",
    "reply", "respond", "response", "sidebar", "sponsor",
)
NAMES = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class _Element:
    name: str
    parent: int
    never: bool
    hinted: bool
    article: bool
    link: bool
    holds_article: bool = False


def _named(values: str) -> list[str]:
    return NAMES.findall(CAMEL.sub(" ", values).lower())


def _suggests(names: list[str]) -> bool:
    return any(n in HINTS or n.startswith(HINT_STARTS) for n in names)


def _element(name: str, attributes: str, parent: int) -> _Element:
    never, hinted, article = name in NEVER_TEXT, False, name in ("article", "main")
    if len(attributes) > 1:
        found = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in ATTRIBUTE.finditer(attributes)}
        role = found.get("role", "").lower()
        never = never or role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        never = never or bool(HIDDEN.search(found.get("style", "")))
        names = _named(f"{found.get('class', '')} {found.get('id', '')}")
        hinted = name in HINTED and _suggests(names)
        if article or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
            article = not any(n.startswith(("comment", "reply", "replies", "teaser", "related")) for n in names)
            hinted = not article
    return _Element(name, parent, never, hinted, article, name == "a")


def blocks(html: str) -> list[tuple[str, str]]:
    """The text blocks of a page in order, as ``(zone, text)``.

    Character references are decoded and white space is one space. Zones: ``ARTICLE``; ``BOILERPLATE``
    by element, role, class or id; ``OUTSIDE`` the article of a page that has one; ``OPEN`` in others.
    Open blocks that are mostly links are boilerplate. Unclosed and misnested tags are put right in
    the usual way; whatever cannot be a tag is text.
    """
    elements = [_Element("", -1, False, False, False, False)]
    stack = [0]
    pieces: list[tuple[int, int, str]] = []
    block = at = 0
    length = len(html)
    while at < length:
        match = TAG.search(html, at)
        if match is None:
            pieces.append((block, stack[-1], html[at:]))
            break
        if match.start() > at:
            pieces.append((block, stack[-1], html[at : match.start()]))
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            if name in BLOCKS:
                block += 1
            for place in range(len(stack) - 1, 0, -1):
                if elements[stack[place]].name == name:
                    del stack[place:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else length
            continue
        if name in VOID:
            if name in BLOCKS:
                block += 1
            elif name == "br":
                pieces.append((block, stack[-1], " "))
            continue
        if name in BLOCKS:
            block += 1
            _close(stack, elements, name)
        own = _element(name, match[3], stack[-1])
        if own.article:
            for number in stack:
                elements[number].holds_article = True
        stack.append(len(elements))
        elements.append(own)
    return _zoned(elements, pieces)


def _close(stack: list[int], elements: list[_Element], name: str) -> None:
    """Ends what the start of a block ends by itself: an open paragraph, or the item or cell before."""
    stops = SAME_ENDS.get(name)
    for place in range(len(stack) - 1, 0, -1):
        open_name = elements[stack[place]].name
        if open_name == "p" or (stops and (open_name == name or {open_name, name} == {"td", "th"} or {open_name, name} == {"dt", "dd"})):
            del stack[place:]
            return
        if open_name in BLOCKS and (not stops or open_name in stops):
            return


def _zoned(elements: list[_Element], pieces: list[tuple[int, int, str]]) -> list[tuple[str, str]]:
    dropped, inside, linked = [False], [False], [False]
    for element in elements[1:]:
        goes = (element.never and not (element.holds_article and element.name == "form")) or (
            element.hinted and not element.holds_article
        )
        dropped.append(dropped[element.parent] or goes)
        inside.append(inside[element.parent] or element.article)
        linked.append(linked[element.parent] or element.link)
    whole = any(e.article and not dropped[i] for i, e in enumerate(elements))
    found: list[tuple[str, str]] = []
    start = 0
    while start < len(pieces):
        end = start
        while end < len(pieces) and pieces[end][0] == pieces[start][0]:
            end += 1
        run = pieces[start:end]
        start = end
        kept = [(node, text) for _, node, text in run if not dropped[node]]
        gone = _clean([text for _, node, text in run if dropped[node]])
        text = _clean([t for _, t in kept])
        if text:
            if any(inside[node] for node, t in kept if not t.isspace()):
                zone = ARTICLE
            elif whole:
                zone = OUTSIDE
            else:
                in_links = sum(len(t) for node, t in kept if linked[node])
                zone = BOILERPLATE if in_links * 2 > sum(len(t) for _, t in kept) else OPEN
            found.append((zone, text))
        if gone:
            found.append((BOILERPLATE, gone))
    return found


def _clean(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def repeated_tokens(streams: list[np.ndarray], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each stream of token numbers a mask of the tokens in runs of ``run`` or more that ``pages`` streams hold.

    The streams are joined, each closed by a mark of its own. Suffixes are ranked by their first 1, 2,
    4, ... tokens (prefix doubling) and sorted; neighbours with equal rank share ``run`` tokens.
    """
    lengths = np.array([len(s) + 1 for s in streams])
    total = int(lengths.sum())
    page = np.repeat(np.arange(len(streams)), lengths)
    ranks = np.empty(total, np.int64)
    ends = np.cumsum(lengths) - 1
    inner = np.ones(total, dtype=bool)
    inner[ends] = False
    ranks[inner] = np.concatenate(streams) + len(streams) if total > len(streams) else []
    ranks[ends] = np.arange(len(streams))
    width = 1
    while width < run:
        step = min(width, run - width)
        later = np.zeros(total, np.int64)
        later[: max(0, total - step)] = ranks[step:] + 1
        _, ranks = np.unique(ranks * (int(later.max()) + 1) + later, return_inverse=True)
        width += step
    suffixes = np.lexsort((page, ranks))
    rank, owner = ranks[suffixes], page[suffixes]
    new_rank = np.concatenate(([True], rank[1:] != rank[:-1]))
    new_owner = new_rank | np.concatenate(([True], owner[1:] != owner[:-1]))
    group = np.cumsum(new_rank) - 1
    owners = np.bincount(group, new_owner)
    begins = suffixes[owners[group] >= pages]
    marks = np.zeros(total + run + 1, np.int64)
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + run, -1)
    covered = np.cumsum(marks)[:total] > 0
    return [covered[end - n + 1 : end] for n, end in zip(lengths, ends, strict=True)]


def _numbered(different: Iterable[str]) -> tuple[list[np.ndarray], dict[str, int]]:
    """Texts as streams of token numbers, and the number of each token."""
    numbers: dict[str, int] = {}
    streams = []
    for words in different:
        tokens = words.split(" ") if words else []
        streams.append(np.array([numbers.setdefault(t, len(numbers)) for t in tokens], dtype=np.int64))
    return streams, numbers


def window_hashes(streams: list[np.ndarray], numbers: dict[str, int], run: int, host: str) -> list[np.ndarray]:
    """Of each stream the 64-bit hashes of all its runs of ``run`` tokens; other hosts have other hashes."""
    seed = xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"))
    hashed = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seed) for t in numbers], np.uint64)
    out = []
    for stream in streams:
        tokens = hashed[stream] if len(stream) else np.zeros(0, np.uint64)
        folded = np.zeros(max(0, len(stream) - run + 1), np.uint64)
        for k in range(run):
            folded = folded * WINDOW_MIX + tokens[k : k + len(folded)]
        out.append(folded.view(np.int64))
    return out


def beside_article(page: list[tuple[str, str]]) -> list[str]:
    """The blocks that repetition is looked for in: all but the article, whose copies are no boilerplate."""
    return [text for zone, text in page if zone != ARTICLE]


def main_texts(
    pages: list[list[tuple[str, str]]],
    run: int = RUN,
    least_pages: int = PAGES,
    host: str = "",
    elsewhere: np.ndarray | None = None,
) -> list[tuple[str, int, int]]:
    """Of a host's pages the main text, the number of tokens, and how many beside the article repeat across pages.

    The article, where there is one, even an empty one; else the open blocks without the runs that repeat: a
    block that they cover goes, of one that they cover in part the rest stays, if it is a run's length, else the
    whole block. If that leaves a page nothing, its open blocks stay: it is a copy, not boilerplate. Pages with
    the same words count once.
    ``elsewhere`` holds the hashes of runs that repeat in the whole of a ``host`` of which these are some pages.
    """
    if not pages:
        return []
    different: dict[str, int] = {}
    copy_of = [different.setdefault(" ".join(text for _, text in page), len(different)) for page in pages]
    beside = dict(zip(copy_of, map(beside_article, pages), strict=True))
    streams, numbers = _numbered(" ".join(beside[i]) for i in range(len(different)))
    covered = repeated_tokens(streams, run, least_pages)
    if elsewhere is not None and len(elsewhere):
        for mask, hashes in zip(covered, window_hashes(streams, numbers, run, host), strict=True):
            begins = np.flatnonzero(np.isin(hashes, elsewhere))
            for k in range(run):
                mask[begins + k] = True
    out = []
    for page, number in zip(pages, copy_of, strict=True):
        mask, at, total = covered[number], 0, 0
        article, unique, open_ = [], [], []
        has_article = False
        for zone, text in page:
            has_article = has_article or zone in (ARTICLE, OUTSIDE)
            tokens = text.count(" ") + 1
            total += tokens
            if zone == ARTICLE:
                article.append(text)
                continue
            repeats = mask[at : at + tokens]
            at += tokens
            if zone == OPEN:
                open_.append(text)
                rest = int((~repeats).sum())
                if rest >= run:
                    unique.append(" ".join(compress(text.split(" "), ~repeats)))
                elif rest:
                    unique.append(text)
        chosen = article if has_article else (unique or open_)
        out.append(("\n".join(chosen), total, int(mask.sum())))
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        pages, words = [], []
        for value in batch.column("html"):
            found = blocks(value.as_py().replace("\x00", ""))
            joined = " ".join(text for _, text in found).encode("utf-8", "surrogatepass")
            words.append(xxhash.xxh64_intdigest(joined) >> 1)
            pages.append(packer.compress(CUT.join(zone + text for zone, text in found).encode("utf-8", "surrogatepass")))
        kept = batch.drop_columns(["html"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(words, pa.int64()), pa.array(pages, pa.binary())],
            names=[*kept.schema.names, "words", "blocks"],
        )


def _given(table: pa.Table | pa.RecordBatch) -> list[list[tuple[str, str]]]:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    given = []
    for packed in binaries(table.column("blocks")):
        text = unpacker.decompress(packed).decode("utf-8", "surrogatepass")
        given.append([(x[0], x[1:]) for x in text.split(CUT)] if text else [])
    return given


def _windows(run: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each page of a large host the different hashes of its runs beside the article, under the page's words."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, (host, page) in enumerate(zip(batch.column("host").to_pylist(), _given(batch), strict=True)):
                (hashes,) = window_hashes(*_numbered([" ".join(beside_article(page))]), run, host or "")
                found.append(np.unique(hashes))
                owner.append(np.full(len(found[-1]), i, np.int64))
            none = np.zeros(0, np.int64)
            rows, hashes = pa.array(np.concatenate([none, *owner])), np.concatenate([none, *found])
            taken = [batch.column(name).take(rows) for name in ("host", "part", "words")]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(hashes)], names=["host", "part", "words", "hash"])

    return windows


def _extractor(run: int, pages: int) -> Callable[..., pa.Table]:
    def extract(table: pa.Table, elsewhere: np.ndarray | None = None) -> pa.Table:
        host = (table.column("host")[0].as_py() or "") if table.num_rows else ""
        texts = main_texts(_given(table), run, pages, host, elsewhere)
        columns = {
            "page_id": table.column("page_id"),
            "url": table.column("url"),
            "text": pa.array([t.encode("utf-8", "replace").decode() for t, _, _ in texts], pa.string()),
            "n_tokens": pa.array([n for _, n, _ in texts], pa.int64()),
            "n_repeated": pa.array([n for _, _, n in texts], pa.int64()),
        }
        return pa.table(columns)

    return extract


def extracted(
    pages: DataFrame,
    run: int = RUN,
    least_pages: int = PAGES,
    group_bytes: int = GROUP_BYTES,
    staging: Staging | None = None,
) -> DataFrame:
    """``page_id, url, text, n_tokens, n_repeated`` of every page: its main text, read from the whole html.

    Null and empty html give an empty text. ``n_tokens`` are the tokens of all visible blocks,
    ``n_repeated`` those beside the article in runs of ``run`` tokens that ``least_pages`` different pages of
    the host hold; longer repeated strings are covered by their runs. Pages go to tasks by host,
    compressed. Hosts of over ``group_bytes`` of html, among them pages without a url, are dealt to several
    groups by a hash of page and url, so neither an unbounded host nor the copies of a page make a task.
    Their runs are counted by 64-bit hashes over the whole host, a page's words once, and each group gets
    the hashes of its runs that repeat in the host, so the size of groups changes no result. Repeated rows
    and further columns do not matter.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        host_and_path(F.col("url"))[0].alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    sizes = rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("size")).where(F.col("size") > group_bytes)
    large = sizes.select("host", F.ceil(F.col("size") / group_bytes).alias("groups"))
    hot = large.limit(MOST_HOT + 1).count()
    dealt = rows.join(F.broadcast(large) if hot <= MOST_HOT else large, "host", "left")
    part = F.when(F.col("groups").isNull(), 0).otherwise(F.pmod(F.xxhash64("page_id", "url"), F.col("groups")))
    dealt = dealt.select("page_id", "url", "host", part.alias("part"), F.col("groups").isNotNull().alias("large"), "html")
    kind = "page_id long, url string, host string, part long, large boolean, words long, blocks binary"
    parsed = dealt.mapInArrow(_parsed, kind)
    out, extract = "page_id long, url string, text string, n_tokens long, n_repeated long", _extractor(run, least_pages)
    if not hot:
        return parsed.groupBy("host", "part").applyInArrow(lambda table: extract(table), out)
    staging = staging_for(pages.sparkSession, staging)
    of_large = dealt.where("large").mapInArrow(_parsed, kind).select("host", "part", "words", "blocks")
    windows = staging.keep(of_large.mapInArrow(_windows(run), "host string, part long, words long, hash long"), "windows")
    counted = windows.groupBy("host", "hash").agg(F.count_distinct("words").alias("pages")).where(F.col("pages") >= least_pages)
    asked = windows.select("host", "part", "hash").distinct().alias("a")
    known = counted.select("host", "hash").alias("k")
    repeated = asked.join(known, F.expr("a.host <=> k.host AND a.hash = k.hash"), "left_semi").select("host", "part", "hash")

    def with_repeated(table: pa.Table, runs: pa.Table) -> pa.Table:
        return extract(table, runs.column("hash").to_numpy())

    return parsed.groupBy("host", "part").cogroup(repeated.groupBy("host", "part")).applyInArrow(with_repeated, out)
