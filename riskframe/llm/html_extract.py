"""Main text of HTML pages by structure and nearest-URL page differencing.

A page is cut into text lines (one a block). Lines inside ``article`` or
``main`` are text; lines inside menus, headers, footers, sidebars, notices,
adverts, forms and comments, told by tag, role, class or id, are not. Names
never mark headings, the article or what surrounds it; inside it a class has
to be a name as a whole, and one that holds a name leaves its lines
undecided. Where a page has no article, all other lines are undecided. An
undecided line is text unless a neighbour has it too. Pages of a host are sorted by URL path; each is paired with the page before and after
it, the lines of both are aligned by longest common subsequence, and shared
lines go. Equal pages of one path count once, and a pair that shares nine
tenths of its characters or more is two copies of one page, which tells
nothing about the site's template: it deletes nothing.

Differencing alone cannot give right results where menus and adverts change
from page to page, or where two pages of a host share a passage of their
articles; that is why marked lines are decided by their marks.

Neighbours are found by a range sort on (host, path), so a host of any size
is dealt over many tasks; rows are numbered and cut into ``RUN`` rows, with
the rows at the ends copied to both sides, and each run is aligned by
itself. Only line hashes are sorted; texts stay where they were parsed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches
from riskframe.llm.url_filter import host_of, path_of

RUN = 256          # pages aligned together
PARTITION_PAGES = 20_000
SAME_PAGE = 0.9    # share of characters in common from which two pages are copies

# Elements and names that mark what a line is.
_RAW = "script style noscript template textarea iframe svg annotation title object audio video canvas"
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp "
              "small span strike strong sub sup time tt u var wbr nobr img "
              "math mi mn mo ms mrow msup msub msubsup mfrac msqrt mroot mtext munder mover semantics".split())
_BOILERPLATE = set("nav footer aside form button select option optgroup menu dialog fieldset datalist".split())
_TEXT = {"article", "main"}
_NAMES = set("ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
             "banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup sidebar sidebars menu menus "
             "nav navbar navigation navigations breadcrumb breadcrumbs footer header masthead topbar comment comments "
             "commentlist respond reply replies disqus share sharing social related recommended widget widgets popup "
             "modal overlay toolbar login pagination pager copyright legal skip search".split())
_COMMENTS = set("comment comments commentlist respond reply replies disqus".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_ROLES = set("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW.split()) + r")\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S | re.I)
_MARKS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[^a-z0-9]+")


# What marks say of an element: nothing, undecided, boilerplate unless it surrounds the article, boilerplate.
_CLEAR, _DOUBT, _NAMED, _OUT = range(4)


def _mark(tag: str, attrs: str, inside_text: bool) -> int:
    if tag in _BOILERPLATE or (tag == "header" and not inside_text):
        return _OUT
    if not attrs or "=" not in attrs or tag in ("body", "html", "main") or (tag == "article" and not inside_text):
        return _CLEAR
    found = _CLEAR
    for kind, *values in _MARKS.findall(attrs):
        kind, value = kind.lower(), "".join(values).lower()
        if kind == "role":
            if value.strip() in _ROLES:
                return _OUT
            continue
        if tag in _HEADINGS:
            continue
        whole = set(value.split())
        if not inside_text:
            if whole & _NAMES or kind == "class" and any(x in _NAMES for x in _PART.split(value)):
                found = max(found, _NAMED)
            elif any(x in _NAMES for x in _PART.split(value)):
                found = max(found, _DOUBT)
        elif kind == "class":
            if whole & _NAMES:
                return _OUT
            if any(x in _NAMES for x in _PART.split(value)):
                found = max(found, _DOUBT)
        elif whole & _COMMENTS or (whole & _NAMES and tag not in ("p", "section")):
            return _OUT
        elif whole & _NAMES:
            found = max(found, _DOUBT)
    return found


#: What becomes of a line: it goes, is undecided, or is text.
DROPPED, UNDECIDED, TEXT = range(3)


def text_lines(page: str) -> list[tuple[str, int]]:
    """(line, fate) of every line that is not marked as boilerplate."""
    out: list[tuple[str, bool, int]] = []      # line, inside the article, mark
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []    # open elements: tag, mark, inside article or main
    state = lambda: (stack[-1][1], stack[-1][2]) if stack else (_CLEAR, False)

    def flush() -> None:
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            held.clear()
            mark, text = state()
            if line and mark < _OUT:
                out.append((line, text, mark))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        attrs = m["attrs"] or ""
        if tag in ("br", "hr"):
            held.append("\n")
            continue
        if tag in _VOID or tag in _INLINE and (m["end"] or _mark(tag, attrs, True) < _OUT):
            if not (m["end"] and any(t == tag for t, _, _ in stack)):
                continue
        if tag in ("td", "th", "dt", "dd", "option") and _mark(tag, attrs, True) < _OUT:
            held.append(" ")
            continue
        flush()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in _TEXT and tag not in ("body", "html"):
                    break  # a stray end tag does not close the article
            continue
        if stack and stack[-1][0] == "p" and tag not in _INLINE:
            stack.pop()  # a block ends an open paragraph
        above, text = state()
        mark = max(above, _mark(tag, attrs, text))
        if tag in _TEXT and not text and mark == _DOUBT:
            mark = _CLEAR  # an id around the article says nothing of it
        text = text or tag in _TEXT
        if tag == "p" and mark == above or attrs.endswith("/"):
            continue  # an unmarked paragraph changes nothing
        stack.append((tag, mark, text))
    if at < len(page):
        held.append(page[at:])
    flush()
    # An article in a named element is the page's text if the page has no other.
    own = any(text and mark < _NAMED for _, text, mark in out)
    named = not own and any(text for _, text, _ in out)

    def fate(text: bool, mark: int) -> int:
        if own or named:
            if not text or (own and mark == _NAMED):
                return DROPPED
            return UNDECIDED if mark == _DOUBT else TEXT
        return DROPPED if mark == _NAMED else UNDECIDED

    fates = [(line, fate(text, mark), mark) for line, text, mark in out]
    return [(line, f) for line, f, mark in fates if f != DROPPED or mark < _NAMED]


def _row(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of x with every prefix of y."""
    row = np.zeros(len(y) + 1, np.int32)
    for h in x:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == h)))
    return row


def common_lines(x: np.ndarray, y: np.ndarray, at: int = 0) -> list[int]:
    """Positions in x of a longest common subsequence with y (Hirschberg: linear memory)."""
    lo = 0
    while lo < min(len(x), len(y)) and x[lo] == y[lo]:
        lo += 1
    hi = 0
    while hi < min(len(x), len(y)) - lo and x[len(x) - 1 - hi] == y[len(y) - 1 - hi]:
        hi += 1
    ends = [*range(at, at + lo)], [*range(at + len(x) - hi, at + len(x))]
    x, y, at = x[lo:len(x) - hi], y[lo:len(y) - hi], at + lo
    if not len(x) or not len(y):
        middle: list[int] = []
    elif len(x) == 1:
        middle = [at] if (y == x[0]).any() else []
    else:
        half = len(x) // 2
        cut = int((_row(x[:half], y) + _row(x[half:][::-1], y[::-1])[::-1]).argmax())
        middle = common_lines(x[:half], y[:cut], at) + common_lines(x[half:], y[cut:], at + half)
    return ends[0] + middle + ends[1]


_PARSED = ("page_id bigint, url string, host string, path string, marked boolean, "
           "lines array<struct<line:string,place:int,open:boolean>>, hashes array<bigint>, sizes array<int>")
_LINE = pa.struct([("line", pa.string()), ("place", pa.int32()), ("open", pa.bool_())])


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        lines, hashes, sizes, marks = [], [], [], []
        for i in range(len(batch)):
            found = text_lines(batch.column(4)[i].as_py() or "")
            marks.append(all(f != UNDECIDED for _, f in found))  # nothing is left to the neighbours
            lines.append([(x, n, f == UNDECIDED) for n, (x, f) in enumerate(found) if f != DROPPED])
            every = [x.encode() for x, _ in found]
            hashes.append([zlib.crc32(x) | (zlib.adler32(x) << 31) for x in every])
            sizes.append([len(x) for x, _ in found])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in range(4)], pa.array(marks), pa.array(lines, pa.list_(_LINE)),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
            names=["page_id", "url", "host", "path", "marked", "lines", "hashes", "sizes"])


def _align(table: pa.Table) -> pa.Table:
    """Rows of one run, with the rows next to it, to the lines that each page of the run shares."""
    rows = table.sort_by("number").to_pylist()
    shared: list[set[int]] = [set() for _ in rows]
    hashes = [np.array(r["hashes"], np.int64) for r in rows]
    for a in range(len(rows) - 1):
        b = a + 1
        x, y = rows[a], rows[b]
        if x["host"] != y["host"] or y["number"] != x["number"] + 1 or (x["marked"] and y["marked"]):
            continue  # no undecided line in either
        left, right = common_lines(hashes[a], hashes[b]), common_lines(hashes[b], hashes[a])
        same = sum(x["sizes"][k] for k in left)
        if 2 * same >= SAME_PAGE * (sum(x["sizes"]) + sum(y["sizes"])):
            continue
        shared[a].update(left)
        shared[b].update(right)
    own = [k for k, r in enumerate(rows) if r["own"] and not r["marked"] and shared[k]]
    return pa.table({"host": pa.array([rows[k]["host"] for k in own], pa.string()),
                     "path": pa.array([rows[k]["path"] for k in own], pa.string()),
                     "digest": pa.array([rows[k]["digest"] for k in own], pa.int64()),
                     "shared": pa.array([sorted(shared[k]) for k in own], pa.list_(pa.int32()))})


def _numbered(ordered: DataFrame) -> DataFrame:
    """Consecutive numbers in the order of a written, range-sorted table with a ``place``
    (partition and row); only partition sizes are gathered."""
    size = ordered.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = size.select("part", before.alias("before"))
    return (ordered.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offsets), "part")
            .withColumn("number", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, text, n_chars (code points), n_shared (lines deleted
    by differencing).

    The text is the main text's lines joined by an empty line; empty for
    null, empty or textless HTML. A null url has the empty host and path.
    Very long pages are read whole. Rows that repeat are all returned, and
    equal rows get equal texts; an empty table gives no rows. Other columns are not looked at.
    """
    url = F.col("url")
    base = (small_batches(pages).select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .select("page_id", "url", host_of(url).alias("host"),
                    path_of(url).alias("path"), "html"))
    parsed = saved(base.mapInArrow(_parse_batches, _PARSED).withColumn("digest", F.xxhash64("marked", "hashes")), "parsed")
    total = parsed.count()
    key = ["host", "path", "digest"]
    ordered = saved(parsed.groupBy(*key).agg(*[F.any_value(c).alias(c) for c in ("marked", "hashes", "sizes")])
                    .repartitionByRange(max(1, -(-total // PARTITION_PAGES)), *key).sortWithinPartitions(*key)
                    .withColumn("place", F.monotonically_increasing_id()), "ordered")
    rows = _numbered(ordered).withColumn("run", F.floor(F.col("number") / RUN))
    where = F.array(F.struct(F.col("run").alias("run"), F.lit(True).alias("own")),
                    F.when(F.col("number") % RUN == 0, F.struct((F.col("run") - 1).alias("run"), F.lit(False).alias("own"))),
                    F.when(F.col("number") % RUN == RUN - 1, F.struct((F.col("run") + 1).alias("run"), F.lit(False).alias("own"))))
    placed = (rows.withColumn("at", F.explode(F.filter(where, lambda x: x.isNotNull())))
              .select(F.col("at.run").alias("run"), F.col("at.own").alias("own"), "number", *key, "marked", "hashes", "sizes"))
    shared = (placed.groupBy("run").applyInArrow(
        _align, "host string, path string, digest bigint, shared array<int>"))
    decided = parsed.filter("marked").select("page_id", "url", F.col("lines.line").alias("lines"), F.lit(0).alias("n_shared"))
    kept = F.when(F.col("shared").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~(x["open"] & F.array_contains("shared", x["place"]))))
    open_ = (parsed.filter("not marked").join(shared, key, "left")
             .select("page_id", "url", F.size("lines").alias("n"), kept.alias("kept"))
             .select("page_id", "url", F.col("kept.line").alias("lines"), (F.col("n") - F.size("kept")).alias("n_shared")))
    text = F.concat_ws("\n\n", "lines")
    return decided.unionByName(open_).select(
        F.col("page_id").alias(id_col), F.col("url").alias(url_col), text.alias("text"),
        F.char_length(text).cast("long").alias("n_chars"), "n_shared")
