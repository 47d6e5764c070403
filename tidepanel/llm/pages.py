"""Main text of web pages, by their structure and by differences from the page with the nearest URL."""

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.urls import host
from tidepanel.session import settle

RANGES = 20_000  # most ranges of URLs; the first and last key of each pass through the driver
COPY = 0.9  # a neighbour that shares this much of the main block is a copy, and nothing is deleted for it
LONG = 0.5  # free lines at least so long, by the longest one, are the main block of a page without an article
AT_ONCE = 500  # rows sent on at once

# fixed values: elements of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style template noscript textarea svg iframe object math canvas select title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var br wbr img".split()
)
APART = set("head nav footer aside form dialog menu button".split())  # never main text
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
MAIN = set("article main".split())
# fixed values: which open elements a start tag ends, as HTML lets their end tags out
_ENDS_P = (
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul"
).split()
ENDS: dict[str, tuple[str, ...]] = {name: ("p",) for name in _ENDS_P} | {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "caption", "colgroup", "p"),
    "thead": ("caption", "colgroup", "thead", "tbody", "tfoot"), "tbody": ("caption", "colgroup", "thead", "tbody", "tfoot"),
    "tfoot": ("caption", "colgroup", "thead", "tbody", "tfoot"), "body": ("head",), "article": ("head", "p"), "main": ("head", "p"),
}
SCOPES = set("table ul ol menu dl button".split())  # a start tag inside ends nothing that was open before
# fixed values: class names and ids that name what is not main text, alone or as the last part of a longer name
NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay menu menus nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside footer header masthead topbar toolbar comment comments disqus replies respond share sharing "
    "newsletter subscribe subscription signup login pagination pager".split()
)
# and such that also do as the first part, as in "comment-list" or "ad_slot-3"
LEADING = set("ad ads advert adverts sponsored promo cookie breadcrumb sidebar comment comments disqus newsletter navbar".split())
# these can name a part of an article too, and count outside of it only
OUTSIDE = set("side discussion social related recommended search form widget skip copyright".split())
_TAG = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")
_STOP = re.compile("[>\"']")
FREE, APART_MARK, MAIN_MARK = "o", "x", "m"


def _names_apart(value: str, inside_main: bool) -> bool:
    """Whether one of the class names or ids in ``value`` says that the element is not main text."""
    for token in value.split():
        parts = _PART.findall(token)
        if parts and (parts[-1] in NAMES or parts[0] in LEADING or not inside_main and len(parts) == 1 and parts[0] in OUTSIDE):
            return True
    return False


def _kind(name: str, rest: str, inside_main: bool) -> str:
    """x: not main text; m: main text; o: neither."""
    if name in APART or name == "header" and not inside_main:
        return APART_MARK
    named = [(k.lower(), (a or b or c).lower()) for k, a, b, c in _NAMED.findall(rest)] if rest else []
    for key, value in named:
        if key == "role":
            if value in ROLES:
                return APART_MARK
            if value == "main":
                return MAIN_MARK
        elif name not in MAIN and name not in ("body", "html") and _names_apart(value, inside_main):
            return APART_MARK
    return MAIN_MARK if name in MAIN else FREE


class _Ends:
    """Where the tags of a page end. Each place is looked at a bounded number of times, whatever is left unclosed."""

    def __init__(self, page: str):
        self.page, self.known, self.stop, self.stop_from = page, {}, -1, len(page) + 1

    def _next(self, at: int) -> int:
        """The first >, " or ' from ``at`` on, or -1; every place between two of them has the same answer."""
        if not self.stop_from <= at <= (self.stop if self.stop >= 0 else len(self.page)):
            found = _STOP.search(self.page, at)
            self.stop_from, self.stop = at, found.start() if found else -1
        return self.stop

    def of(self, at: int) -> int:
        """Behind the > of a tag whose name ends at ``at``; a > between quotes does not count. -1 if it has none."""
        seen, end = [], -1
        place = self._next(at)
        while place >= 0:
            if place in self.known:
                end = self.known[place]
                break
            seen.append(place)
            if self.page[place] == ">":
                end = place + 1
                break
            quote = self.page.find(self.page[place], place + 1)
            found = _STOP.search(self.page, quote + 1) if quote >= 0 else None
            place = found.start() if found else -1
        self.known.update(dict.fromkeys(seen, end))
        return end


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(begin, end, "/" or "", name, attributes) of each tag; comments, declarations and the elements whose content is
    never text come with an empty name. A < without an end is text."""
    ends, at, no_more = _Ends(page), 0, set()
    while found := _TAG.search(page, at):
        begin, at = found.span()
        name = (found[2] or "").lower()
        if page.startswith("<!--", begin):
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else len(page)
            yield begin, at, "", "", ""
            continue
        if name:
            end = ends.of(at)
        elif ">" in no_more:
            end = -1
        else:
            end = page.find(">", at) + 1 or -1
            if end < 0:
                no_more.add(">")
        if end < 0:
            continue
        rest = page[at : end - 1] if name else ""
        at = end
        if name in SKIPPED and not found[1]:
            if not (rest.endswith("/") and name in ("svg", "math")):
                close = re.compile(rf"</{name}\s*>", re.I).search(page, end)
                at = close.end() if close else len(page)
            name = ""
        yield begin, at, found[1] or "", name, rest


class _Open:
    """The open elements, with counts, so that no tag has to look through them in vain."""

    def __init__(self):
        self.elements: list[tuple[str, str]] = []
        self.counts: Counter = Counter()
        self.scopes: list[Counter] = [Counter()]
        self.kinds: Counter = Counter()

    def push(self, name: str, kind: str) -> None:
        self.elements.append((name, kind))
        self.counts[name] += 1
        self.kinds[kind] += 1
        self.scopes[-1][name] += 1
        if name in SCOPES:
            self.scopes.append(Counter())

    def pop_to(self, *names: str) -> None:
        """Closes the innermost element of these names and all inside it."""
        while True:
            name, kind = self.elements.pop()
            if name in SCOPES:
                self.scopes.pop()
            self.counts[name] -= 1
            self.kinds[kind] -= 1
            self.scopes[-1][name] -= 1
            if name in names:
                return

    def end_implied(self, name: str) -> None:
        if name in SCOPES or name in ENDS:
            for other in ENDS.get(name, ()):
                while self.scopes[-1][other] > 0:
                    self.pop_to(other)


def blocks(page: str) -> list[tuple[str, str]]:
    """(mark, text) of each block of the page with text: x is apart from the main text, m inside it, o free.

    End tags that HTML lets out are implied (ENDS). Time grows with the length of the page, also if nothing is closed.
    """
    found: list[tuple[str, str]] = []
    opened = _Open()
    pieces: list[str] = []
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                kinds = opened.kinds
                found.append((APART_MARK if kinds[APART_MARK] else MAIN_MARK if kinds[MAIN_MARK] else FREE, text))

    for begin, end, close, name, rest in _tokens(page):
        if begin > at:
            pieces.append(page[at:begin])
        at = end
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            # an inline element counts only if its names say that it is apart, and then until it closes
            if close:
                if not opened.counts[name]:
                    continue
            elif name in VOID or not rest or _kind(name, rest, opened.kinds[MAIN_MARK] > 0) != APART_MARK:
                continue
        flush()
        if close:
            if opened.counts[name]:
                opened.pop_to(name)
            continue
        if name not in INLINE:
            opened.end_implied(name)
        if name not in VOID and not rest.endswith("/"):
            opened.push(name, _kind(name, rest, opened.kinds[MAIN_MARK] > 0))
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return found


def common(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``; bit j of a row tells whether column j adds none."""
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for line in a:
        hit = row & places.get(line, 0)
        row = (row + hit | row - hit) & full
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def main_text(marks: str, lines: list[str], others: list[list[str]]) -> tuple[str, bool]:
    """The lines that stay of a page, and whether one of ``others``, nearest first, has decided by its differences.

    The page's own lines are those inside an article or main element, or the free ones of a page without such an
    element. All lines are aligned in order with those of the first of ``others`` that is no copy, and own lines
    that both have go. A copy has COPY of the page's main block: its article, or its LONG free lines, as the short
    lines of a common frame do not make a copy.
    """
    mark = MAIN_MARK if MAIN_MARK in marks else FREE
    own = [i for i, m in enumerate(marks) if m == mark]
    least = 0 if mark == MAIN_MARK else LONG * max((len(lines[i]) for i in own), default=0)
    block = [i for i in own if len(lines[i]) >= least]
    for other in others if own else []:
        shared = set(common(lines, other))
        if sum(len(lines[i]) for i in block if i in shared) < COPY * sum(len(lines[i]) for i in block):
            return "\n".join(lines[i] for i in own if i not in shared), True
    return "\n".join(lines[i] for i in own), False


def _neighbours(parts: DataFrame, order: list[str]) -> tuple[list, dict, dict]:
    """First key of each range, and which ranges need a key's page as the nearest one of another URL before their
    first page, or after their last one. A URL whose captures fill whole ranges is passed over."""
    key = F.struct(*order)
    ends = parts.groupBy("_range").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    ends = settle(ends, "url-ends")
    inner = parts.join(F.broadcast(ends), "_range").groupBy("_range").agg(  # RANGES rows at most
        F.max(F.when(F.col("_url") != F.col("b._url"), key)).alias("before"),
        F.min(F.when(F.col("_url") != F.col("a._url"), key)).alias("after"),
    )
    found = sorted(
        (tuple(r["a"]), tuple(r["b"]), r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"]))
        for r in ends.join(inner, "_range").collect()
    )
    link = order.index("_url")
    wanted: tuple[dict, dict] = ({}, {})

    def carried(numbers: range, near: int, far: int, within: int, out: dict) -> None:
        key = last = None
        for n in numbers:
            if last is not None:
                url = found[n][near][link]
                if found[last][far][link] != url:
                    key = found[last][far]
                elif found[last][within] is not None:
                    key = found[last][within]
                if key is not None:
                    out.setdefault(key, []).append(n)
            last = n

    carried(range(len(found)), 0, 1, 2, wanted[0])
    carried(range(len(found) - 1, -1, -1), 1, 0, 3, wanted[1])
    return [r[0] for r in found], *wanted


def extracted(pages: DataFrame) -> DataFrame:
    """The main text of each row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Blocks come from the markup. Each page's lines are aligned by a longest common subsequence with those of the
    nearest page of another URL by URL path within its host: the one before it, or the one after it if there is none
    before or that is a copy. Other captures of the same URL are passed over. Shared lines go. Structure only adds to
    that: menus, headers, footers, sidebars, notices, adverts, forms and comments go, known by their elements, roles
    and class names, and on a page with an article or main element also what is outside.

    Pages are cut into blocks before they move, then dealt out once by ranges of host and path; only four keys of
    each range pass through the driver, and tasks stream through their ranges. They hold back the captures of one
    URL that wait for the page after them.

    Null or empty html, or no block: empty text, n_chars 0. Null url: host and path are empty. A neighbour that has
    nearly all of the main block is a copy, and nothing goes for it. Repeated rows: each gives its own row. Empty
    table: no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    url = F.coalesce("url", F.lit(""))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    order = ["_host", "_path", "_url", "_id"]
    keyed = pages.select(
        "page_id", "url", "html", host(F.col("url")).alias("_host"), path.alias("_path"), url.alias("_url"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(-(2**63))).alias("_id"),
    )
    keys = keyed.select(*order)
    count = keys.count()
    ranges = max(1, min(RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // 2_000), count // 200))
    firsts, before_of, after_of = [], {}, {}
    if count:
        parts = settle(keys.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "url-ranges")
        firsts, before_of, after_of = _neighbours(parts, order)
    # code points and UTF-8 bytes sort alike, so Python compares as Spark does

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "url", *order, "_marks", "_lines", "_range", "_role"]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            out["page_id"] = out["page_id"].astype("Int64")
            return out

        for batch in batches:
            rows = []
            for page, link, source, *key in batch.itertuples(index=False):
                found = blocks(source or "")
                own = (key[0], key[1], key[2], int(key[3]))
                place = max(bisect_right(firsts, own) - 1, 0)
                row = (page, link, *own, "".join(m for m, _ in found), "\n".join(t for _, t in found))
                rows.append((*row, place, 1))
                for role, wanted in ((0, before_of), (2, after_of)):
                    for where in wanted.get(own, ()):
                        rows.append((*row, where, role))
                        if len(rows) >= AT_ONCE:
                            yield frame(rows)
                            rows = []
            yield frame(rows)

    moved = keyed.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *order).mapInPandas(
        cut,
        "page_id long, url string, _host string, _path string, _url string, _id long, _marks string, _lines string, "
        "_range int, _role int",
    )
    moved = moved.repartition(ranges, "_range").sortWithinPartitions("_range", *order, "_role")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = other = None  # the row before, and the last one of another URL
        waiting: list = []  # captures of one URL that have no use for the page before

        def split(row) -> list[str]:
            return row.lines.split("\n") if row.lines else []

        def near(row, neighbour) -> list[list[str]]:
            here = neighbour is not None and neighbour.place == row.place and neighbour.host == row.host
            return [split(neighbour)] if here else []

        def result(row, text: str) -> tuple:
            return None if pd.isna(row.page_id) else int(row.page_id), row.url, text, len(text)

        def closed(neighbour) -> list[tuple]:
            out = [result(row, main_text(row.marks, split(row), near(row, neighbour))[0]) for row in waiting]
            waiting.clear()
            return out

        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["page_id", "url", "text", "n_chars"])
            out["page_id"] = out["page_id"].astype("Int64")
            return out

        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if last is not None and (last.place != row.place or last.link != row.link):
                    rows += closed(row)
                    other = last
                last = row
                if row.role != 1:
                    continue
                text, decided = main_text(row.marks, split(row), near(row, other))
                if decided:
                    rows.append(result(row, text))
                else:
                    waiting.append(row)
            yield frame(rows)
        yield frame(closed(None))

    return moved.select(
        "page_id", "url", F.col("_host").alias("host"), F.col("_url").alias("link"), F.col("_marks").alias("marks"),
        F.col("_lines").alias("lines"), F.col("_range").alias("place"), F.col("_role").alias("role"),
    ).mapInPandas(compare, "page_id long, url string, text string, n_chars long")
