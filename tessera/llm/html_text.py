"""Operator 1: main text of HTML pages, by nearest-URL page differencing; markup decides what that leaves open.

A page becomes text lines, one a block element, in page order; scripts and styles are none. The page is compared with the page nearest by URL
path on its host: all lines of both are aligned by their longest common subsequence, and the shared lines are deleted. An
element path most of whose lines are shared is the host's template, and its other lines go as well (a menu's own entry, say).
If all lines are shared the pages are copies, which tells nothing of the page.

Two things that a neighbour cannot tell are read from the markup. Lines in <article> or <main> are protected, as pages of a host may
share a passage or a licence line of their articles, which is content. And what differs from page to page without being
the article (adverts, notices, reader comments, related links, forms) goes by element, role, class or id. A page
whose <article> or <main> holds most of the text that is left is that part alone. A class or id counts only if all its parts
are such names, never for a heading or paragraph by its id, and not at all where it would take three quarters of that part.

Pages of a host are neighbours in the order of path, URL, page_id, text. Buckets of that order are
cut at keys that a hash of the row selects, so a host that holds a third of all
pages is spread, and results do not depend on how files are read. The first page of a bucket looks
only forward.

Nulls and empties: a null url has an empty host and path, a null html is empty and
gives an empty text. Repeated rows each give a row. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, slices

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title noembed noframes audio video".split())
DROPPED = frozenset("head nav footer aside form button select menu dialog datalist input label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " footer sidebar aside toc cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " comment comments commentlist disqus replies respond related recommended recommendations pagination pager toolbar widget widgets outbrain taboola".split())
#: The same outside of an article alone, where they may belong to its own head.
OUTER_MARKS = MARKS | frozenset("header masthead topbar search skip copyright".split())
#: Words that such names are made of beside them.
PARTS = frozenset("box bar block area section container wrapper wrap inner outer content main page site global post entry article top bottom left right primary secondary list item items link links unit slot panel col column row text group sticky fixed message posts pages stories articles products lists thread count button buttons icon icons title heading body user users reader readers visitor facebook fb google dfp gpt leaderboard skyscraper mpu billboard rectangle law policy form email mail trail path x info message messages feed stack sign up in our latest mobile desktop responsive large small mailing".split())
SPLIT = re.compile(r"[^a-z]+")
#: Characters of a bucket of neighbouring pages, about.
BUCKET = 64 << 20
#: Why a line may go: a class or id, or an element, role or state.
NAMED, MARKED = 1, 2


def _named(value: str, marks: frozenset[str]) -> bool:
    """Whether one of the names in a class or id is made of marks, and of nothing but marks and PARTS."""
    for name in value.split():
        words = {w for w in SPLIT.split(name) if w}
        if words & marks and words <= marks | PARTS:
            return True
    return False


def _kind(tag: str, attributes: str, in_main: bool) -> int:
    if tag in DROPPED or (tag == "header" and not in_main):
        return MARKED
    if not attributes or tag in ("html", "body", "main", "article"):
        return 0
    kind = 0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")) or (name == "role" and value in ROLES):
            return MARKED
        if (name == "class" or (name == "id" and tag not in PROSE)) and _named(value, MARKS if in_main else OUTER_MARKS):
            kind = NAMED
    return kind


Line = tuple[str, bool, int, str]


def lines(page: str) -> list[Line]:
    """(text, inside article or main, kind, element path) of every block, and of what a block's own parts of another kind say."""
    out: list[Line] = []
    part: list[tuple[int, str]] = []
    stack: list[tuple[str, int, bool, str]] = []  # (element, kind of its content, inside main, path), innermost last
    kind, main, path, at = 0, False, "", 0

    def block() -> None:
        for k in sorted({k for k, _ in part}):
            text = " ".join("".join(t for kk, t in part if kk == k).split())
            if text:
                out.append((text, main, k, path))
        part.clear()

    def pop_to(k: int) -> None:
        nonlocal kind, main, path
        del stack[k:]
        _, kind, main, path = stack[-1] if stack else ("", 0, False, "")

    while True:
        m = TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            part.append((kind, entities.unescape(text)))
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            part.append((kind, m[1]))
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if tag in BLOCKS:
                block()
            if k is not None:
                pop_to(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ("br", "td", "th", "img"):
            part.append((kind, " "))
        if tag in BLOCKS:
            block()
            closes = ("p",) if tag != "li" else ("p", "li")  # an open <p> ends where a block starts, an <li> at the next one
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in closes or stack[k][0] in ("ul", "ol", "div", "section", "article", "main", "body", "table", "td", "blockquote")), None)
            if k is not None and stack[k][0] in closes:
                pop_to(k)
        if tag in VOID or m[4].endswith("/>"):
            continue
        own = max(kind, _kind(tag, m[4], main))
        deep = f"{path}/{tag}"[-400:] if tag in BLOCKS else path
        stack.append((tag, own, main or tag in ("article", "main") or "role=\"main\"" in m[4], deep))
        _, kind, main, path = stack[-1]
    block()
    return out


def _row(a: list[str], b: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of a with each beginning of b, by one bit of a whole number for each line of b."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    row, ones = (1 << len(b)) - 1, (1 << len(b)) - 1
    for x in a:
        m = row & where.get(x, 0)
        row = ((row + m) | (row - m)) & ones
    out = [0]
    for bit in f"{row:0{len(b)}b}"[::-1] if b else "":
        out.append(out[-1] + (bit == "0"))
    return out


def _halved(a: list[str], b: list[str], at: int) -> set[int]:
    """The same as shared() in little memory (Hirschberg), for pages that repeat lines very often; at: index of a's first line."""
    if not a or not b:
        return set()
    if len(a) == 1:
        return {at} if a[0] in b else set()
    half = len(a) // 2
    left, right = _row(a[:half], b), _row(a[half:][::-1], b[::-1])
    k = max(range(len(b) + 1), key=lambda k: left[k] + right[len(b) - k])
    return _halved(a[:half], b[:k], at) | _halved(a[half:], b[k:], at + half)


#: Equal pairs of lines that are listed one by one; more are compared by bits.
LISTED = 1_000_000


def shared(a: list[str], b: list[str]) -> set[int]:
    """Indices of a that lie on a longest common subsequence of lines with b (Hunt and Szymanski)."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    out = {*range(lo), *range(ea, len(a))}
    where = defaultdict(list)
    for j in range(lo, eb):
        where[b[j]].append(j)
    if sum(len(where.get(x, ())) for x in a[lo:ea]) > LISTED:
        return out | _halved(a[lo:ea], b[lo:eb], lo)
    ends: list[int] = []  # ends[k]: least end in b of a common subsequence of k + 1 lines
    last: list[tuple] = []  # its last link (index in a, link before)
    for i in range(lo, ea):
        for j in reversed(where.get(a[i], ())):
            k = bisect.bisect_left(ends, j)
            link = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            else:
                ends[k], last[k] = j, link
    link = last[-1] if last else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(own: list[Line], other: list[Line] | None) -> tuple[str, int]:
    """The main text, and the number of lines that went because the neighbour has them or most of their path."""
    common = shared([x[0] for x in own], [x[0] for x in other]) if other else set()
    if len(common) == len(own):
        common = set()
    paths: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for i, (_, main, _, path) in enumerate(own):
        if not main and path.rpartition("/")[2] not in PROSE:
            paths[path][0] += 1
            paths[path][1] += i in common
    template = {path for path, (n, k) in paths.items() if k and 2 * k >= n and path.count("/") > 2}
    centred = any(main and kind < MARKED for _, main, kind, _ in own)
    scope = [i for i, (_, main, kind, _) in enumerate(own) if kind < MARKED and i not in common and main == centred]
    named = sum(len(own[i][0]) for i in scope if own[i][2] == NAMED)
    most = 4 * named > 3 * sum(len(own[i][0]) for i in scope)
    stays = lambda i: not own[i][2] or (most and own[i][2] == NAMED and own[i][1] == centred)
    left = [i for i, (_, main, _, path) in enumerate(own) if stays(i) and (main or (i not in common and path not in template))]
    inside = [i for i in left if own[i][1]]
    if 2 * sum(len(own[i][0]) for i in inside) >= sum(len(own[i][0]) for i in left):
        left = inside or left
    went = sum(not main and (i in common or path in template) for i, (_, main, _, path) in enumerate(own))
    return "\n".join(own[i][0] for i in left), went


def _parse(bounds: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for full in batches for part in slices(full, 5)):
            rows = []
            for key, host, path, page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                found = lines(page or "")
                k = bisect.bisect_right(bounds, key)
                row = (key, host, path, page_id, url, *(list(c) for c in zip(*found))) if found else (key, host, path, page_id, url, [], [], [], [])
                rows.append((k, False, *row))
                if k and bounds[k - 1] == key:
                    rows.append((k - 1, True, *row))  # the page after the last one of the bucket before
            cols = list(zip(*rows)) or [[]] * 11
            kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int8()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["bucket", "guest", "key", "host", "path", "page_id", "url", "lines", "main", "kinds", "paths"])

    return run


PARSED = "bucket int, guest boolean, key string, host string, path string, page_id long, url string, lines array<string>, main array<boolean>, kinds array<byte>, paths array<string>"
OUT = "page_id long, url string, text string, n_chars long, n_shared int"


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of buckets in order of key; each is compared with the nearer of its two neighbours on its host."""
    before = row = None

    def result(after) -> tuple:
        near = [x for x in (after, before) if x and x[0] == row[0] and x[3] == row[3]]
        near = max(near, key=lambda x: _alike(x[4], row[4]), default=None)
        both = lambda r: list(zip(*r[7:11])) if r else None
        text, n = main_text(both(row), both(near))
        return row[5], row[6], text, len(text), n

    for batch in batches:
        out = []
        for new in zip(*(c.to_pylist() for c in batch.columns)):
            if row and not row[1]:
                out.append(result(new))
            before, row = row, new
        yield _out(out)
    if row and not row[1]:
        yield _out([result(None)])


def _out(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32()))], names=["page_id", "url", "text", "n_chars", "n_shared"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_shared (lines deleted because the nearest page has them)."""
    parts = partitions(pages.sparkSession)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    page_id = F.col("page_id").cast("long")
    key = F.concat_ws("\u0001", host, path, url, F.lpad(F.coalesce(page_id, F.lit(-1)).cast("string"), 20, "0"))
    rows = pages.select(key.alias("key"), host.alias("host"), path.alias("path"), page_id.alias("page_id"), F.col("url"), F.col("html"))
    n, size = pages.agg(F.count(F.lit(1)), F.sum(F.length("html"))).first()
    buckets = max(2 * parts, (size or 0) // BUCKET)
    every = max(1, n // (32 * buckets))  # about 32 keys a bucket are looked at, whatever the number of pages
    seen = rows.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).groupBy("key").agg(F.sum(F.length("html")).alias("size")).orderBy("key").collect() if n > 1000 else []
    bounds, held, share = [], 0, sum(r["size"] or 0 for r in seen) / buckets
    for r in seen:  # cut where a bucket's share of the characters is reached
        if held and held + (r["size"] or 0) > share:
            bounds.append(r["key"])
            held = 0
        held += r["size"] or 0
    parsed = rows.mapInArrow(_parse(bounds), PARSED)
    order = ["bucket", "guest", "key", F.hash("lines")]
    return parsed.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions(*order).mapInArrow(_pair, OUT)
