"""Main text of pages by wrappers: union-free regular expressions inferred per host.

Every page becomes a sequence of nested block elements and text slots. Pages of one host are aligned one after
another: equal elements are merged, an element only one side has becomes optional, an element or a short
run of elements that comes several times in a row becomes a repeated group, and texts become slots that
know whether all pages agree on them. Where a list stays irregular it is generalised to a repeated
group of optional elements, still without a union. The wrapper then says which part of the host's pages
is the article, and each page is read by matching it to the wrapper.

All pages take part. Equal shapes of a host are first counted together on the map side; the distinct ones
are aligned in groups of bounded size, round by round, until a host has one wrapper.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel
from hazemart.llm.markup import HEADINGS, Page
from hazemart.session import settled

#: shapes of one host aligned by one task in one round
FAN = 64
#: children of a wrapper element before the list is generalised
MAX_ITEMS = 40
#: elements of the longest run that is looked for as a repeated group
PERIOD = 4
#: pages that must agree on a text outside of an article element before it is taken for the template's
TEMPLATE_PAGES = 5
#: an element that holds this share of its parent's text is the article rather than the parent
MAIN_SHARE = 0.75
#: copies of the wrappers when they meet the pages in an exchange, so a host with many pages is split
SPREAD = 16

# an item is ["#", 1, repeated, stats] for a text slot, [label, least, repeated, items] for an element and
# ["()", least, repeated, items] for a group; stats are [pages, least hash, greatest hash, characters, of links]
SLOT, GROUP = "#", "()"


# Fixed value: elements that hold the blocks of an article rather than its text.
_CONTAINERS = frozenset("div section td center table tbody tr body html main ul ol li dl dd form fieldset".split())
_SINGLE = frozenset("html body main".split())


def _tag(label: str) -> str:
    return label.replace("#", ".").replace("!", ".").split(".")[0]


def _labels(item: list) -> set[str]:
    return {k[0] for k in item[3]} if item[0] == GROUP else {item[0]}


def _fits(a: list, b: list) -> bool:
    return a[0] == b[0] if GROUP not in (a[0], b[0]) else not _labels(a).isdisjoint(_labels(b))


def _likeness(a: list, b: list) -> float:
    """0 for items that do not fit, 1 to 2 by what their contents share; containers that share nothing do not fit."""
    if not _fits(a, b):
        return 0.0
    if a[0] == SLOT or GROUP in (a[0], b[0]):
        return 1.0
    left, right = ({name for k in x[3] for name in _labels(k)} for x in (a, b))
    shared = len(left & right) / len(left | right) if left or right else 1.0
    return 1.0 + shared if shared or _tag(a[0]) not in _CONTAINERS - _SINGLE else 0.0


def _repeats(a: list, b: list) -> bool:
    """Whether neighbours are instances of one item: containers only where at least half of their contents agree."""
    return _fits(a, b) if _tag(a[0]) not in _CONTAINERS or GROUP in (a[0], b[0]) else _likeness(a, b) >= 1.5


def _merged(a: list, b: list, one_page: bool) -> list:
    least, repeated = min(a[1], b[1]), a[2] or b[2]
    if a[0] == b[0] == SLOT:
        (n, low, high, size, links), (m, low2, high2, size2, links2) = a[3], b[3]
        return [SLOT, least, repeated, [max(n, m) if one_page else n + m, min(low, low2), max(high, high2), size + size2, links + links2]]
    if GROUP in (a[0], b[0]):
        left, right = (x[3] if x[0] == GROUP else [x] for x in (a, b))
        return [GROUP, least, True, aligned(left, right, one_page)]
    return [a[0], least, repeated, aligned(a[3], b[3], one_page)]


def _optional(item: list) -> list:
    return [item[0], 0, item[2], item[3]]


def aligned(a: list, b: list, one_page: bool = False) -> list:
    """One list of items that both lists are instances of."""
    if not a or not b:
        return [_optional(x) for x in a or b]
    if len(a) == len(b) and all(_repeats(x, y) for x, y in zip(a, b, strict=True)):
        return folded([_merged(x, y, one_page) for x, y in zip(a, b, strict=True)])
    # common subsequence of the most alike items; what it leaves out is optional
    like = [[_likeness(x, y) for y in b] for x in a]
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], like[i][j] + best[i + 1][j + 1] if like[i][j] else 0.0)
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if like[i][j] and best[i][j] == like[i][j] + best[i + 1][j + 1]:
            out.append(_merged(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return folded(out + [_optional(x) for x in (*a[i:], *b[j:])])


def folded(items: list) -> list:
    """Neighbours that repeat each other as repeated items or groups; a list that stays long is generalised."""
    out: list = []
    skip = 0
    for at, item in enumerate(items):
        if skip:
            skip -= 1
            continue
        if out and out[-1][0] == GROUP:
            # the next whole run of the group, before its items are taken one by one as optional
            run = items[at : at + len(out[-1][3])]
            if [k[0] for k in run] == [k[0] for k in out[-1][3]]:
                out[-1] = [GROUP, out[-1][1], True, [_merged(x, y, True) for x, y in zip(out[-1][3], run, strict=True)]]
                skip = len(run) - 1
                continue
        if out and _repeats(out[-1], item):
            merged = _merged(out[-1], item, True)
            out[-1] = [merged[0], max(out[-1][1], item[1]), True, merged[3]]
        else:
            out.append(item)
        for period in range(2, PERIOD + 1):
            left, right = out[-2 * period : -period], out[-period:]
            if len(left) == period and all(x[0] == y[0] != GROUP and _repeats(x, y) for x, y in zip(left, right, strict=True)):
                group = [_merged(x, y, True) for x, y in zip(left, right, strict=True)]
                out[-2 * period :] = [[GROUP, 1, True, [[g[0], g[1], x[2] or y[2], g[3]] for g, x, y in zip(group, left, right, strict=True)]]]
                break
    if len(out) > MAX_ITEMS:
        flat: dict[str, list] = {}
        for item in out:
            for k in item[3] if item[0] == GROUP else [item]:
                flat[k[0]] = _optional(_merged(flat[k[0]], k, True) if k[0] in flat else k)
        return [[GROUP, 0, True, list(flat.values())]]
    return out


def page_items(element: list) -> list:
    """The items of one page's tree, repeats folded."""
    out = []
    for kid in element[1]:
        if isinstance(kid, tuple):
            value = zlib.crc32(kid[0].encode("utf-8", "surrogatepass"))
            out.append([SLOT, 1, False, [1, value, value, len(kid[0]), kid[1]]])
        else:
            out.append([kid[0], 1, False, page_items(kid)])
    return folded(out)


def packed(items: list) -> tuple[str, list[list[int]]]:
    """Shape as text, and the stats of its slots in order."""
    stats: list[list[int]] = []

    def strip(item: list) -> list:
        if item[0] == SLOT:
            stats.append(item[3])
            return [SLOT, item[1], int(item[2]), 0]
        return [item[0], item[1], int(item[2]), [strip(k) for k in item[3]]]

    return json.dumps([strip(k) for k in items], separators=(",", ":"), ensure_ascii=False), stats


def unpacked(shape: str, stats: list[list[int]]) -> list:
    left = iter(stats)

    def fill(item: list) -> list:
        if item[0] == SLOT:
            return [SLOT, item[1], bool(item[2]), list(next(left))]
        return [item[0], item[1], bool(item[2]), [fill(k) for k in item[3]]]

    return [fill(k) for k in json.loads(shape)]


# ---- what of a wrapper is the article ----

ARTICLE, BODY, TITLE, TEMPLATE = "article", "body", "title", "template"
def _walk(items: list, above: tuple = ()) -> Iterator[tuple[list, tuple]]:
    for item in items:
        yield item, above
        if item[0] != SLOT:
            yield from _walk(item[3], (*above, item))


def _rank(label: str) -> int | None:
    """Which elements are the article: article before main before a named body."""
    if _tag(label) == "article":
        return 0
    if _tag(label) == "main" or label.endswith("!main"):
        return 1
    return 2 if label.endswith("!body") else None


def judged(items: list) -> list:
    """The wrapper with a mark on elements (article, body, title) and slots (template): [label, repeated, items or 0, mark]."""
    marks: dict[int, str] = {}
    everything = list(_walk(items))
    wanted = [(_rank(item[0]), item, above) for item, above in everything if item[0] != SLOT and _rank(item[0]) is not None]
    chosen = min((w[0] for w in wanted), default=None)
    for rank, item, above in wanted:
        if rank == chosen and not any(marks.get(id(a)) for a in above):
            marks[id(item)] = ARTICLE
    inside = {id(item) for item, above in everything if any(marks.get(id(a)) for a in (*above, item))}
    varied = any(item[3][1] != item[3][2] for item, _ in everything if item[0] == SLOT)
    weight: dict[int, int] = {}
    for item, above in everything:
        if item[0] != SLOT or id(item) in inside:
            continue
        pages, low, high, size, links = item[3]
        heading = any(_tag(a[0]) in HEADINGS for a in above)
        if varied and low == high and pages >= TEMPLATE_PAGES and not heading or 2 * links > size:
            marks[id(item)] = TEMPLATE
            continue
        for node in (*above, item):
            weight[id(node)] = weight.get(id(node), 0) + size - links
    # pages without an article element: down to the element whose text is no longer held by one child
    place, holder = items, None
    while total := sum(weight.get(id(k), 0) for k in place):
        heaviest = max(place, key=lambda k: weight.get(id(k), 0))
        if _tag(heaviest[0]) not in _CONTAINERS or heaviest[2] or id(heaviest) in inside or weight[id(heaviest)] < MAIN_SHARE * total:
            break
        place, holder = heaviest[3], heaviest
    if holder is not None:
        marks[id(holder)] = BODY
    titled = any(_tag(item[0]) == "h1" and id(item) in inside for item, _ in everything)
    for item, above in everything:
        if _tag(item[0]) == "h1" and id(item) not in inside:
            differs = any(k[3][1] != k[3][2] for k, _ in _walk(item[3]) if k[0] == SLOT)
            marks[id(item)] = ARTICLE if chosen is not None and differs and not titled else TITLE

    def strip(item: list) -> list:
        return [item[0], int(item[2]), 0 if item[0] == SLOT else [strip(k) for k in item[3]], marks.get(id(item), "")]

    return [strip(k) for k in items]


class Wrapper:
    """Reads pages of one host."""

    def __init__(self, rules: str):
        self.items = self._flat(json.loads(rules))

    def _flat(self, items: list) -> list[tuple]:
        """(label, first place to look at next, items, mark, labels within): a repeated item may follow itself, one of a group any of the group."""
        out: list[tuple] = []
        for label, repeated, inner, mark in items:
            if label == GROUP:
                start = len(out)
                out += [(name, start, *others) for name, _, *others in self._flat(inner)]
            else:
                below = self._flat(inner) if inner else []
                out.append((label, len(out) + (not repeated), below, mark, {k[0] for k in below}))
        return out

    def main_text(self, page: Page) -> str:
        texts: dict[str, list[str]] = {ARTICLE: [], BODY: [], "": []}
        seen = set()

        def read(element: list, items: list[tuple], inside: str) -> None:
            at = 0
            for kid in element[1]:
                own = () if isinstance(kid, tuple) else {SLOT if isinstance(k, tuple) else k[0] for k in kid[1]}
                label = SLOT if isinstance(kid, tuple) else kid[0]
                places = [k for k in range(at, len(items)) if items[k][0] == label] or [k for k in range(at) if items[k][0] == label]
                if places:
                    # the first of those that have most in common with the element
                    found = max(places, key=lambda k: (len(items[k][4].intersection(own)) / (len(items[k][4].union(own)) or 1), -k))
                    _, at, below, mark, _ = items[found]
                else:
                    below, mark = [], ""
                if isinstance(kid, tuple):
                    texts[""].append(kid[0])
                    if inside == ARTICLE or inside and mark != TEMPLATE:
                        texts[ARTICLE if inside == ARTICLE else BODY].append(kid[0])
                else:
                    seen.add(mark)
                    read(kid, below, mark if mark == ARTICLE or mark and inside != ARTICLE else inside)

        read(page.root, self.items, "")
        return "\n".join(texts[ARTICLE if ARTICLE in seen else BODY if BODY in seen else ""])


SHAPES = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("shape", T.StringType()), T.StructField("slot", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in ("pages", "low", "high", "size", "links")],
])
WRAPPERS = "host string, shape string, stats array<array<bigint>>"


def page_shapes(pages: DataFrame) -> DataFrame:
    """(host, shape, stats) of all pages (_host, _html): one row for each distinct shape of a host."""

    def shapes(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found: dict[tuple[str, str], list[list[int]]] = {}
        for host, source in zip(batch.column("_host").to_pylist(), batch.column("_html").to_pylist(), strict=True):
            shape, stats = packed(page_items(Page(source or "").root))
            known = found.get((host, shape))
            if known is None:
                found[host, shape] = stats
            else:
                for k, (new, old) in enumerate(zip(stats, known, strict=True)):
                    known[k] = [old[0] + new[0], min(old[1], new[1]), max(old[2], new[2]), old[3] + new[3], old[4] + new[4]]
        rows = [(host, shape, k, *s) for (host, shape), stats in found.items() for k, s in enumerate(stats)]
        if not rows:
            return None
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=SHAPES.names
        )

    slots = kernel.arrow_map(pages, shapes, SHAPES, "_html", 4 << 20)
    summed = slots.groupBy("host", "shape", "slot").agg(
        F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size"), F.sum("links").alias("links")
    )
    lists = F.sort_array(F.collect_list(F.struct("slot", F.array("pages", "low", "high", "size", "links").alias("stats"))))
    return summed.groupBy("host", "shape").agg(lists.alias("slots")).select("host", "shape", F.col("slots.stats").alias("stats"))


def _aligned_group(group: pa.Table) -> pa.Table:
    rows = sorted(zip(group.column("shape").to_pylist(), group.column("stats").to_pylist(), strict=True))
    items = functools.reduce(aligned, (unpacked(*row) for row in rows))
    shape, stats = packed(items)
    return pa.Table.from_arrays(
        [group.column("host").slice(0, 1), pa.array([shape]), pa.array([stats], pa.list_(pa.list_(pa.int64())))], names=["host", "shape", "stats"]
    )


def host_wrappers(shapes: DataFrame) -> DataFrame:
    """(host, rules): the distinct shapes of each host aligned to one wrapper, in an order that depends on them alone."""
    level = settled(shapes, "shapes")
    while True:
        counted = level.join(level.groupBy("host").agg(F.count("*").alias("n")), "host")
        if counted.where(F.col("n") > 1).limit(1).count() == 0:
            break
        bucket = F.pmod(F.xxhash64("shape"), F.ceil(F.col("n") / FAN))
        groups = counted.where(F.col("n") > 1).withColumn("bucket", bucket).groupBy("host", "bucket")
        level = settled(counted.where(F.col("n") == 1).drop("n").unionByName(groups.applyInArrow(_aligned_group, WRAPPERS)), "shapes")

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                json.dumps(judged(unpacked(*row)), separators=(",", ":"), ensure_ascii=False)
                for row in zip(batch.column("shape").to_pylist(), batch.column("stats").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], names=["host", "rules"])

    return settled(level.mapInArrow(rules, "host string, rules string"), "wrappers")


@functools.lru_cache(512)
def _wrapper(rules: str) -> Wrapper:
    return Wrapper(rules)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if none), n_chars (its code points).

    Blocks of the article in page order joined by one line feed; within a block character references are
    decoded and white space (of Unicode) is one space. ``br`` is white space. On hosts with article elements those are the
    text (else ``main``), of other hosts the element that holds most of the text outside of links and of what
    all pages share, with its h1. Headers inside an article keep their headings. Null and empty html, and pages
    without any text, give an empty text; null or odd urls are one host; repeated rows are rows each. Other
    columns are not read; an empty table gives no rows.
    """
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url_col).cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host.alias("_host"))
    wrappers = host_wrappers(page_shapes(source.select("_host", "_html")))
    # small wrappers are broadcast, their size is known from their files; others meet the pages in an exchange
    copies = wrappers.select(F.col("host").alias("_host"), "rules", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_part"))
    spread = source.withColumn("_part", F.pmod(F.xxhash64("_url", "_id"), F.lit(SPREAD)).cast("int"))
    schema = T.StructType([
        T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, pages.schema[url_col].dataType),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [
            _wrapper(rules or "[]").main_text(Page(page)) if page else ""
            for page, rules in zip(batch.column("_html").to_pylist(), batch.column("rules").to_pylist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names
        )

    joined = spread.join(copies, ["_host", "_part"], "left").select("_id", "_url", "_html", "rules")
    return kernel.arrow_map(joined, read, schema, "_html", 4 << 20)
