"""Main text of web pages.

Every page goes through nearest-URL differencing: pages of a host are sorted by URL path, each
is paired with the nearer of its two neighbours, their whole lines, those of menus and footers
too, are aligned by longest common subsequence, and the shared lines are the template. Query,
fragment, a trailing slash and a .html ending do not make another page, and a page whose main
lines are those of its pair is a copy of it, of which nothing is template.

The markup then checks this line by line. What it names as menu, header, footer, sidebar, notice,
advert, form or reader comments goes, shared or not; scripts and styles are no lines at all. A shared
line inside the page's own article stays, because two articles may share a sentence.

Names of classes and ids count as wholes: a compound names a page part if all its words do, or
describe its place. An element that holds the article or main part is a wrapper and stays, whatever its name
starts with. An article with less text than stands beside it is a teaser and decides nothing.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.llm.shared import partitions, written

# Elements and names of page parts.
_DROPPED = frozenset("nav footer aside form menu dialog button select textarea script style noscript "
                     "template svg iframe object canvas head title audio video".split())
_RAW = frozenset("script style textarea title noscript template iframe svg".split())
_UNREAD = _RAW | {"head", "object", "canvas", "audio", "video"}
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset "
                    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
                    "menu nav ol option p pre section summary table tbody tfoot thead tr ul caption".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SPACED = frozenset("br td th img".split())
_WHOLE = frozenset("html body article main".split())
_PARTS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising alert alerts banner banners breadcrumb "
    "breadcrumbs byline comment comments consent cookie cookies disqus footer gdpr header login masthead menu "
    "menubar modal nav navbar navigation newsletter notice notices notification outbrain overlay pager "
    "pagination popup promo promoted promotion related recommendations recommended replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "taboola toolbar widget widgets".split())
# Words that only say where a part stands or what it is made of.
_PLACES = frozenset("area bar block bottom box button buttons fixed form icons item items left link links list main "
                    "mobile primary right row secondary section site sticky top wrap".split())
# Lists of these hold articles that are not the page's.
_TEASERS = frozenset("comment comments disqus promo promoted recommendations recommended related replies sidebar "
                     "sponsored".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z0-9]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")).lower() for k, v in _ATTRIBUTE.findall(text)}


def _names_a_part(name: str, parts: frozenset[str]) -> bool:
    words = set(_WORDS.findall(name))
    return bool(words & parts) and words <= parts | _PLACES


def _part(tag: str, attributes: str, in_article: bool) -> str | None:
    """Whether an element is none of the main text: surely, or unless it holds an article or main part (wrapper)."""
    if tag in _DROPPED or (tag == "header" and not in_article):
        return "wrapper" if tag == "form" else "surely"
    if tag in ("html", "body") or len(attributes) < 4:
        return None
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden") == "true" or _UNSEEN.search(found.get("style", "")):
        return "surely"
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    if not in_article and set(names) & _TEASERS:
        return "surely"
    if found.get("role") in _ROLES:
        return "wrapper"
    parts = _PARTS
    if tag in ("article", "main", "header"):
        parts = frozenset({"comment", "comments", "reply", "related", "ad", "ads", "advert", "sponsored", "promo"})
    return "wrapper" if any(_names_a_part(n, parts) for n in names) else None


def _line(text: list[str]) -> str:
    return _SPACE.sub(" ", html.unescape("".join(text))).strip()


def lines_of(page: str) -> tuple[list[str], list[int], bool]:
    """All lines of a page, the places of those its markup leaves in, and whether it says that these are the
    article."""
    tokens = list(_TOKEN.finditer(page))
    blocks: list[tuple[str, int, int]] = []  # text, inside article, inside main
    lines: list[str] = []
    places: list[int] = []  # of the blocks
    text: list[str] = []
    article = main = 0
    at = i = 0

    def flush() -> None:
        if text:
            joined = _line(text)
            if joined:
                blocks.append((joined, article, main))
                places.append(len(lines))
                lines.append(joined)
            text.clear()

    while i < len(tokens):
        token = tokens[i]
        if token.start() > at:
            text.append(page[at:token.start()])
        at, i = token.end(), i + 1
        tag = (token[2] or "").lower()
        if not tag:
            if token[0].startswith("<![CDATA["):
                text.append(html.escape(token[0][9:].removesuffix("]]>"), quote=False))
            continue
        closing, attributes = token[1], token[3]
        if tag in _BLOCKS:
            flush()
        elif tag in _SPACED:
            text.append(" ")
        if closing:
            article = max(article - (tag == "article"), 0)
            main = max(main - (tag == "main"), 0)
            continue
        part = _part(tag, attributes, article > 0)
        if part and tag not in _VOID and not attributes.endswith("/>"):
            behind, end = _after(page, tokens, i, tag)
            if part == "surely" or article or not _holds_text(tokens, i, behind):
                if tag not in _UNREAD:
                    lines += _part_lines(page, tokens, i, behind, at, end)
                i, at = behind, end
                continue
        if tag in ("article", "main"):
            article, main = article + (tag == "article"), main + (tag == "main")
    if at < len(page):
        text.append(page[at:])
    flush()
    marked = any(m for _, _, m in blocks)
    inside = sum(len(t) for t, a, _ in blocks if a)
    if inside and 2 * inside >= sum(len(t) for t, a, m in blocks if a or m or not marked):
        return lines, [k for k, (_, a, _) in zip(places, blocks, strict=True) if a], True
    if marked:
        return lines, [k for k, (_, _, m) in zip(places, blocks, strict=True) if m], False
    return lines, places, False


def blocks_of(page: str) -> tuple[list[str], bool]:
    """Lines of a page that its markup leaves in, in order, and whether it says that they are the article."""
    lines, kept, sure = lines_of(page)
    return [lines[k] for k in kept], sure


def _part_lines(page: str, tokens: list[re.Match], i: int, behind: int, at: int, end: int) -> list[str]:
    """Lines of a page part: tokens i to behind, text from at to end."""
    lines: list[list[str]] = [[]]
    while i < behind:
        token = tokens[i]
        lines[-1].append(page[at:token.start()])
        at, i = token.end(), i + 1
        tag = (token[2] or "").lower()
        if tag in _UNREAD and not token[1] and not token[3].endswith("/>"):
            i, at = _after(page, tokens, i, tag)
        elif tag in _BLOCKS:
            lines.append([])
        elif tag in _SPACED:
            lines[-1].append(" ")
    lines[-1].append(page[at:end])
    return [line for line in map(_line, lines) if line]


def _holds_text(tokens: list[re.Match], i: int, end: int) -> bool:
    """Whether an article or main part begins among tokens."""
    return any(not tokens[k][1] and (tokens[k][2] or "").lower() in ("article", "main") for k in range(i, end))


def _after(page: str, tokens: list[re.Match], i: int, tag: str) -> tuple[int, int]:
    """Number and place of the token behind an element whose tag was before token i.

    An element without its end reaches to the next article, main or h1, or to the end.
    """
    depth, stop = 1, None
    for k in range(i, len(tokens)):
        name = (tokens[k][2] or "").lower()
        if name == tag:
            if tokens[k][1]:
                depth -= 1
            elif tag not in _RAW and not tokens[k][3].endswith("/>"):
                depth += 1
            if not depth:
                return k + 1, tokens[k].end()
        elif stop is None and name in ("article", "main", "h1") and not tokens[k][1]:
            stop = k
    if stop is None or tag == "footer":
        return len(tokens), len(page)
    return stop, tokens[stop].start()


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in a of one longest common subsequence of a and b.

    Bit-parallel rows over b; every k-th row is kept and the rows between are made again on
    the way back, so memory is len(b) times the root of len(a) bits.
    """
    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    head, tail = list(range(low)), list(range(len(a) - high, len(a)))
    a_mid, b_mid = a[low:len(a) - high], b[low:len(b) - high]
    masks: dict[int, int] = {}
    for j, x in enumerate(b_mid):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b_mid)) - 1

    def step(v: int, x: int) -> int:
        u = v & masks.get(x, 0)
        return ((v + u) | (v - u)) & full

    k = math.isqrt(len(a_mid)) + 1
    kept, v = [full], full
    for i, x in enumerate(a_mid):
        v = step(v, x)
        if (i + 1) % k == 0:
            kept.append(v)
    found, j, i = [], len(b_mid), len(a_mid)
    rows: list[int] = []
    base = -1
    while i and j:
        if i <= base or base < 0 or i > base + len(rows) - 1:
            base = (i - 1) // k * k
            rows = [kept[base // k]]
            for x in a_mid[base:i]:
                rows.append(step(rows[-1], x))
        bit = 1 << (j - 1)
        if rows[i - base] & bit:
            j -= 1
        elif i - 1 >= 1 and not rows[i - 1 - base] & bit:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.append(low + i)
    return head + found[::-1] + tail


def _lines(pages: DataFrame, page_id: str, url: str, html_column: str) -> DataFrame:
    """page_id, hash of the page, host, path, places of the lines that the markup leaves in, hash of each line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(page or "") for page in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([kept for _, kept, _ in found], pa.list_(pa.int32())),
                 pa.array([lines for lines, _, _ in found], pa.list_(pa.string()))],
                ["page_id", "page", "host", "path", "main", "lines"])

    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.xxhash64(F.col(f"`{html_column}`")).alias("page"),
        host.alias("host"), F.regexp_replace(path, r"(?:/|\.html?)+$", "").alias("path"),
        F.col(f"`{html_column}`").alias("html"))
    parsed = rows.mapInArrow(run, "page_id long, page long, host string, path string, main array<int>, "
                             "lines array<string>")
    return parsed.withColumn("lines", F.transform("lines", lambda x: F.xxhash64(x)))


def _partners(lines: DataFrame) -> DataFrame:
    """host, path, and the page of the nearest other path of the host.

    All paths are range-sorted, so a large host is many tasks; only the ends of the ranges, two
    rows for each partition, are brought together.
    """
    paths = lines.groupBy("host", "path").agg(F.min(F.struct("page_id", "page")).alias("rep"))
    ordered = written(paths.repartitionByRange(partitions(lines.sparkSession), "host", "path")
                      .withColumn("part", F.spark_partition_id()), "paths")
    row = F.struct("host", "path", "rep")
    inside, parts = Window.partitionBy("part").orderBy("host", "path"), Window.orderBy("part")
    ends = (ordered.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
            .select("part", F.lag("last").over(parts).alias("ends_before"),
                    F.lead("first").over(parts).alias("starts_after")))
    near = ordered.join(ends, "part").select(
        "host", "path", F.coalesce(F.lag(row).over(inside), "ends_before").alias("a"),
        F.coalesce(F.lead(row).over(inside), "starts_after").alias("b"))
    near = near.select("host", "path", *[F.when(F.col(x)["host"] == F.col("host"), F.col(x)).alias(x) for x in "ab"])
    first = F.col("b").isNull() | (F.levenshtein("path", F.col("a")["path"]) <= F.levenshtein("path", F.col("b")["path"]))
    chosen = F.when(F.col("a").isNotNull() & first, F.col("a")).otherwise(F.col("b"))
    return near.select("host", "path", chosen["rep"].alias("partner")).where("partner IS NOT NULL")


def shared_lines(lines: DataFrame) -> DataFrame:
    """page_id, page, shared: places of the lines that the pair of a page has too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Equal main lines: a copy.
            out = [[] if [a[k] for k in main] == [b[k] for k in theirs] else common_lines(a, b)
                   for a, main, b, theirs in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.list_(pa.int32()))],
                                             ["page_id", "page", "shared"])

    pages = lines.dropDuplicates(["page_id", "page"])
    other = pages.select(F.struct("page_id", "page").alias("partner"), F.col("lines").alias("others"),
                         F.col("main").alias("theirs"))
    paired = pages.where("size(lines) > 0").join(_partners(lines), ["host", "path"]).join(other, "partner")
    found = paired.select("page_id", "page", "lines", "main", "others", "theirs").mapInArrow(
        run, "page_id long, page long, shared array<int>")
    return found.where("size(shared) > 0")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of pages, and n_shared, how many of its lines its pair has too.

    Character references are decoded, white space in a block becomes one space, blocks are
    joined by a line break. A null or empty page has an empty text. Rows without url are pages
    of one nameless host; repeated rows are extracted alike; other columns are ignored whatever
    their names; an empty table gives no rows.
    """
    lines = written(_lines(pages, page_id, url, html_column), "lines")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{html_column}`").alias("html"))
    gone = written(shared_lines(lines), "shared").withColumnsRenamed({"page_id": "id", "page": "of"})
    rows = rows.join(gone, rows.page_id.eqNullSafe(gone.id) & (F.xxhash64("html") == gone.of), "left").select(
        "page_id", "url", "html", "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_shared = [], []
            for page, shared in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                lines, kept, sure = lines_of(page or "")
                template = set(shared or ())
                # Lines of a marked article stay though another article has them too.
                texts.append("\n".join(lines[k] for k in kept if sure or k not in template))
                n_shared.append(len(template))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], np.int64)), pa.array(n_shared, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_shared"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_shared long")
