"""Main text of web pages: nearest-URL page differencing over text lines, with what the markup itself says."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import kept, small_batches

BOILERPLATE, UNDECIDED, MAIN, ARTICLE = 0, 1, 2, 3
# Element names by their meaning in HTML, and words that name page furniture in class, id and role.
SILENT = "script|style|title|noscript|template|textarea|iframe|svg|math|object|audio|video|canvas|select"
FURNITURE = set("nav footer aside form menu dialog head button fieldset".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr notice notices notification popup modal newsletter subscribe signup login share sharing "
    "social comment comments disqus reply replies respond related recommended recommendations pagination pager widget toolbar "
    "complementary contentinfo search alert".split()
)
COMMENTS = set("comment comments reply replies respond disqus".split())
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<silent>{SILENT})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</(?P=silent)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<rest2>[^>]*)>|</?[a-z][^>]*\Z",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
LINES = "struct<levels:array<tinyint>,lines:array<string>>"
SITE_PAGES = 4  # different pages of a host, over half of them too, that must share a line before it goes from an article


def level_of(name: str, rest: str, above: int, inside: bool) -> int:
    """What the element's text is, by its name and attributes; ``inside``: an article or main part is open."""
    if above == BOILERPLATE:
        return BOILERPLATE
    words = {w for m in NAMED.finditer(rest) for w in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower())} if rest else set()
    if name in ("article", "main"):
        return BOILERPLATE if words & COMMENTS else ARTICLE if name == "article" else max(above, MAIN)
    if name in FURNITURE or name == "header" and not inside:
        return BOILERPLATE
    if rest and (words & NAMES or HIDDEN.search(rest) or "header" in words and not inside):
        return BOILERPLATE
    return max(above, MAIN) if words & {"main", "articlebody"} else above


def lines_of(html: str) -> list[tuple[int, str]]:
    """(level, text) of each block of a whole page in page order: references decoded, white space made single."""
    found: list[tuple[int, str]] = []
    held: list[str] = []
    open_tags: list[tuple[str, int]] = []
    level = UNDECIDED

    def flush() -> None:
        if held:
            line = " ".join(unescape("".join(held)).split())
            held.clear()
            if line:
                found.append((level, line))

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, closing = name.lower(), m["end"] or m["end2"]
        rest = m["rest"] or m["rest2"] or ""
        if name in ("html", "body"):
            flush()
            open_tags, level = ([], UNDECIDED) if not closing else (open_tags, level)
            continue
        if closing:
            if name not in INLINE:
                flush()
            place = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), None)
            if place is None:
                continue
            new = open_tags[place - 1][1] if place else UNDECIDED
            if new != level:
                flush()
            del open_tags[place:]
            level = new
            continue
        if name in VOID:
            if name in ("br", "hr"):
                held.append(" ") if name == "br" else flush()
            continue
        if name not in INLINE:
            flush()
        new = level_of(name, rest, level, level >= MAIN)
        if new != level:
            flush()
        if not rest.endswith("/"):
            open_tags.append((name, new))
            level = new
    if at < len(html):
        held.append(html[at:])
    flush()
    return found


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions of ``a`` in a longest common subsequence of both, by bit rows (a row of ``b`` per line of ``a``)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict[int, int] = {}
    for i, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << i
    full = (1 << len(y)) - 1
    rows, state = [], full
    for line in x:
        kept_bits = state & where.get(line, 0)
        state = ((state + kept_bits) | (state - kept_bits)) & full
        rows.append(state)
    row, col, found = len(x), len(y), []
    while row and col:
        if rows[row - 1] >> (col - 1) & 1:
            col -= 1
        else:
            row -= 1
            if not row or rows[row - 1] >> (col - 1) & 1:
                found.append(head + row)
                col -= 1
    return list(range(head)) + found[::-1] + list(range(len(a) - tail, len(a)))


def closeness(a: str, b: str) -> int:
    """Characters that two URL paths share from their start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


KEY = ["host", "path", "page_id", "mark"]
ROW = "host string, path string, page_id string, mark long, lines array<long>"
SHARED = "host string, mark long, lines array<long>, shared array<int>"
EDGE = f"edge boolean, starts boolean, ends boolean, {ROW}, other_path string, other_lines array<long>, shared array<int>"


def _differ(row, *others: tuple[str | None, list | None]) -> list[int]:
    """Lines of ``row`` shared with the neighbour whose path is nearest; the first named wins ties."""
    near = [(closeness(row.path, path), lines) for path, lines in others if lines is not None]
    return common_lines(list(row.lines), list(max(near, key=lambda n: n[0])[1])) if near else []


def _pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each page of a sorted partition against its neighbours; the first and last wait for the next partition's."""
    columns = [x.split()[0] for x in EDGE.split(", ")]

    def result(before, row, after) -> tuple | None:
        same = [(r.path, r.lines) if r is not None and r.host == row.host else (None, None) for r in (before, after)]
        if before is None or after is None:
            inner = same[1] if before is None else same[0]
            return (True, before is None, after is None, *row[1:], *inner, None)
        found = _differ(row, *same)
        return (False, False, False, *row[1:], None, None, found) if found else None

    before = row = None
    for batch in batches:
        out = []
        for after in batch.itertuples():
            if row is not None and (found := result(before, row, after)):
                out.append(found)
            before, row = row, after
        if out:
            yield pd.DataFrame(out, columns=columns, dtype=object)
    if row is not None:
        yield pd.DataFrame([result(before, row, None)], columns=columns, dtype=object)


def shared_lines(lined: DataFrame) -> DataFrame:
    """(host, mark, lines, shared): for every page, the positions of lines that are also on the page with the nearest URL; none: no row.

    ``mark`` tells the pages of a host apart; no two of them may have equal lines. Pages are put in order of host and path by sampled splitters, so a host of any size is spread, and only hashes of
    lines travel. A page's nearest is the one before or after it, on the same host, that shares more of the path. Pages at a
    partition's ends get their outer neighbour in a second step over two rows per partition, so the result doesn't depend on splitters.
    """
    parts = int(lined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lined.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY)
    paired = kept(ordered.mapInPandas(_pair, EDGE))
    line = Window.orderBy(*KEY)
    outer = [F.lag(c).over(line).alias(f"b_{c}") for c in ("host", "path", "lines")] + [F.lead(c).over(line).alias(f"a_{c}") for c in ("host", "path", "lines")]
    edges = paired.where("edge").select("*", *outer)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                before = ((r.b_path, r.b_lines) if r.b_host == r.host else (None, None)) if r.starts else (r.other_path, r.other_lines)
                after = ((r.a_path, r.a_lines) if r.a_host == r.host else (None, None)) if r.ends else (r.other_path, r.other_lines)
                out.append((r.host, r.mark, r.lines, _differ(r, before, after)))
            yield pd.DataFrame(out, columns=["host", "mark", "lines", "shared"], dtype=object)

    inner = paired.where(~F.col("edge")).select("host", "mark", "lines", "shared")
    return inner.unionByName(edges.mapInPandas(finish, SHARED)).where(F.size("shared") > 0).dropDuplicates(["host", "mark"])


def site_lines(shared: DataFrame, alike: DataFrame) -> DataFrame:
    """(host, mark, shared, site): with ``site``, the positions of shared lines that over half of the host's different pages share.

    ``alike`` has a row per different page. At least SITE_PAGES pages must share a line. Lines are counted over all pages of a host.
    """
    places = F.transform("shared", lambda i: F.struct(i.alias("place"), F.get("lines", i).alias("line")))
    each = shared.select("host", "mark", F.explode(places).alias("p")).select("host", "mark", "p.place", "p.line")
    lines = each.groupBy("host", "line").agg(F.count_distinct("mark").alias("n")).where(F.col("n") >= SITE_PAGES)
    sizes = alike.groupBy("host").agg(F.count("*").alias("pages"))
    lines = lines.join(sizes, "host").where(F.col("n") * 2 > F.col("pages")).select("host", "line")
    found = each.join(lines, ["host", "line"]).groupBy("host", "mark").agg(F.collect_list("place").alias("site"))
    return shared.select("host", "mark", "shared").join(found, ["host", "mark"], "left")


def extract(pages: DataFrame, most: int = 50_000) -> DataFrame:
    """(page_id, url, text, n_chars) per page: its main text, blocks joined by a space.

    A page is a list of text lines (blocks), each boilerplate by its markup (menus, footers, adverts, forms and so on), part
    of an article or main element, or undecided. Every page is differenced with the page of the same host whose URL path is nearest:
    lines that also stand there, in the same order (longest common subsequence), are what a site repeats from page to page. A page
    without article or main part gives its undecided lines but the shared ones. In an article or main part, furniture left out, a shared
    line is checked before it goes: over half of the host's different pages and SITE_PAGES must share it, as two stories may have a line
    in common. Pages of a host with equal lines (recrawled or mirrored) count as one, at the first of their paths, so a copy deletes
    nothing; all get its text.

    Null html is empty; pages without url are one host's; rows equal in all columns give equal rows; other columns are ignored. The
    lines to delete are broadcast up to ``most`` pages and joined beyond.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf(LINES)
    def split(texts: pd.Series) -> pd.DataFrame:
        found = [lines_of(t) if t else [] for t in texts]
        return pd.DataFrame({"levels": [[x for x, _ in f] for f in found], "lines": [[x for _, x in f] for f in found]})

    url = F.coalesce("url", F.lit(""))
    path = F.regexp_extract(url, r"^(?:(?:[A-Za-z][\w+.-]*:)?//[^/?#]*)?([^#]*)", 1)
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)", 1))
    own = pages.select("page_id", "url", split(F.coalesce("html", F.lit(""))).alias("_l"))
    own = own.withColumn("_top", F.coalesce(F.array_max("_l.levels"), F.lit(0)))
    hashes = F.transform("_l.lines", lambda x: F.xxhash64(x))
    lined = own.select(host.alias("host"), hashes.alias("lines"), path.alias("path"), F.col("page_id").cast("string").alias("page_id"))
    alike = lined.groupBy("host", "lines").agg(F.min(F.struct("path", "page_id")).alias("f"))
    alike = kept(alike.select("host", "f.path", "f.page_id", F.xxhash64("lines").alias("mark"), "lines"))
    shared = kept(site_lines(kept(shared_lines(alike)), alike)).withColumnRenamed("host", "_host").withColumnRenamed("mark", "_mark")
    small = shared.count() <= most
    match = (host == F.col("_host")) & (F.xxhash64(hashes) == F.col("_mark"))
    joined = own.join(F.broadcast(shared) if small else shared, match, "left")
    places = F.sequence(F.lit(0), F.size("_l.lines") - 1)
    gone = F.coalesce(F.when(F.col("_top") == UNDECIDED, F.col("shared")).otherwise(F.col("site")), F.array().cast("array<int>"))
    stays = F.filter(
        F.when(F.size("_l.lines") > 0, places).otherwise(F.array().cast("array<int>")),
        lambda i: (F.get("_l.levels", i) == F.col("_top")) & (F.col("_top") > BOILERPLATE) & ~F.array_contains(gone, i),
    )
    text = F.array_join(F.transform(stays, lambda i: F.get("_l.lines", i)), " ")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
