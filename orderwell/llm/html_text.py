"""HTML extraction: blocks of a page, without what it shares with the pages of nearest URL.

Method. A page is cut into text blocks (lines) at block-level tags. Pages of a host are brought in the order of their URL
path, and each is paired with its neighbours whose lines differ from its own (copies of a page are one). The longest common
subsequence of the lines of a pair is what the site repeats: menus, notices, footers. Shared lines are deleted.

What the differencing may not decide: lines inside `article` or `main` are kept even if a neighbour repeats them, because a
site may hold near copies of an article; and elements that name themselves as menu, header, footer, sidebar, notice,
advert, form, script, style or comments are left out even where no neighbour repeats them. Names are whole tokens of the
attributes class and id, of containers only; inside an `article` or `main` only names of adverts and comments count, and an
article or list item may be a comment. If a page has an `article` or `main` with text, outside such elements, only what lies
inside belongs to the text.

Pages are read in one pass, in time linear in their length. A tag ends at the first > outside quotes; where a < outside
quotes or the end of the page comes first, it is no tag but text.

Rows: one per page, also for repeated rows. Null and empty html give an empty text. Pages without a host, and a page alone
on its host, are paired with none. Null ids stay null; their pages are paired as others.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import SLICE_BYTES, read, slices
from orderwell.llm.url_filter import ATTRIBUTE, host_of, path_of
from orderwell.session import materialize

# Elements of the HTML standard by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
LEFT_OUT = frozenset(
    "nav header footer aside form menu dialog button select textarea fieldset iframe object svg canvas template noscript head "
    "title script style audio video search".split()
)
CONTENT = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose class or id may name a part of the page.
CONTAINERS = frozenset("div section ul ol dl table tbody tr td center details figure".split())
#: Class and id tokens that name a part which is not the article, alone or with a word of place or shape.
NAMED = re.compile(
    r"(?:(?:site|page|global|main|top|bottom|left|right|primary|secondary|mobile|cookie|social)[_-])?"
    r"(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo|nav|navigation|navbar|menu|breadcrumbs?"
    r"|header|masthead|footer|sidebar|aside|widget|related|recommended|share|sharing|social|cookies?|consent|notices?|popup|modal"
    r"|newsletter|subscribe|signup|login|search|form|comments?|disqus|replies|respond|pagination|pager|toolbar|skip)"
    r"(?:[_-]?(?:\d+|wrapper|container|box|bar|list|area|block|section|inner|top|bottom|left|right|links?))?",
    re.IGNORECASE,
)
#: Names of reader comments, anywhere.
COMMENTS = re.compile(
    r"(?:(?:reader|user|visitor|post|article|blog)s?[_-]?)?(?:comments?|disqus|replies)"
    r"(?:[_-]?(?:\d+|wrapper|container|box|list|area|block|section|thread|body|content|inner|item|feed))?",
    re.IGNORECASE,
)
#: Names of adverts, which count inside an article as well.
ADVERTS = re.compile(
    r"(?:ads?|adverts?|advertisement|advertising|sponsored)(?:[_-]?(?:\d+|wrapper|container|box|list|area|block|section))?",
    re.IGNORECASE,
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog".split())

#: What stands between the name and the end of a tag. Two readings that begin at different tags can never both be in
#: quotes of one kind, and neither reads past a < outside quotes, so no part of a page is read more than a few times.
INSIDE = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b{INSIDE}>.*?(?:</\1\s*+>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>\"']*+)({INSIDE})>|<[!?][^<>]*+>|</[^<>]*+>",
    re.DOTALL | re.IGNORECASE,
)


def _is_left_out(name: str, inside: str, in_content: bool) -> bool:
    if name in LEFT_OUT:
        return True
    if not inside.strip() or name in ("html", "body"):
        return False
    values: dict[str, str] = {}
    for key, a, b, c in ATTRIBUTE.findall(inside):  # the first of a name counts
        values.setdefault(key.lower(), html.unescape(a or b or c))
    if name not in CONTENT:
        if "hidden" in values or values.get("aria-hidden", "").strip().lower() == "true":
            return True
        if values.get("role", "").strip().lower() in ROLES:
            return True
    kinds = []
    if name in CONTAINERS or name in CONTENT or name == "li":
        kinds.append(COMMENTS)
    if name in CONTAINERS:
        kinds.append(ADVERTS if in_content else NAMED)
    names = [x for key in ("class", "id") for x in values.get(key, "").split()]
    return any(kind.fullmatch(x) for kind in kinds for x in names)


def lines_of(page: str | None) -> tuple[list[str], list[bool], list[bool]]:
    """The text blocks of a page; whether each lies in an article; whether each lies in an element that is left out."""
    lines, inside, out = [], [], []
    if not page:
        return lines, inside, out
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, content, left out
    # how often each name is open: in all, and within each open article or main, so that no end tag is looked for in vain
    everywhere: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]
    held: list[str] = []
    in_content = left_out = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            lines.append(text)
            inside.append(in_content > 0)
            out.append(left_out > 0)

    def close() -> str:
        nonlocal in_content, left_out
        name, content, gone = stack.pop()
        in_content -= content
        left_out -= gone
        everywhere[name] -= 1
        scopes[-1][name] -= 1
        if name in CONTENT:
            scopes.pop()
        return name

    past = 0
    for m in TOKEN.finditer(page):
        if m.start() > past:
            held.append(page[past : m.start()])
        past = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue  # a comment, a declaration, or an element whose text is not content
        if name in BLOCKS:
            flush()
        if m[2]:
            # a stray end tag does not close the article
            if (everywhere if name in ("body", "html") else scopes[-1])[name]:
                while close() != name:
                    pass
        elif name not in VOID and not m[4].endswith("/"):
            if name == "p" and stack and stack[-1][0] == "p":
                close()
            # an article in a part that is left out is not the page's
            gone = _is_left_out(name, m[4], in_content > 0)
            content = name in CONTENT and not left_out and not gone
            stack.append((name, content, gone))
            if name in CONTENT:
                scopes.append(Counter())
            everywhere[name] += 1
            scopes[-1][name] += 1
            in_content += content
            left_out += gone
    if past < len(page):
        held.append(page[past:])
    flush()
    return lines, inside, out


def common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence. Equal ends go first, then lines that the other lacks; one row of the
    table is kept per line of what remains, as bits of an integer."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    ia = [i for i in range(start, len(a) - end)]
    ib = [j for j in range(start, len(b) - end)]
    both = set(a[ia].tolist()) & set(b[ib].tolist())
    ia, ib = [i for i in ia if a[i] in both], [j for j in ib if b[j] in both]
    where: dict[int, int] = {}
    for k, j in enumerate(ib):
        where[b[j]] = where.get(b[j], 0) | 1 << k
    full = (1 << len(ib)) - 1
    rows, row = [full], full
    for i in ia:
        hit = row & where[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    pairs, j = [], len(ib) - 1
    for i in range(len(ia) - 1, -1, -1):
        # a zero bit marks a place where the subsequence of the first lines grows
        while j >= 0 and rows[i + 1] >> j & 1:
            j -= 1
        if j < 0:
            break
        if rows[i] >> j & 1:
            pairs.append((ia[i], ib[j]))
            j -= 1
    same = [(i, i) for i in range(start)] + pairs[::-1]
    return same + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


LINES = "host string, path string, lines array<long>"


def page_lines(pages: DataFrame) -> DataFrame:
    """host, path, lines (hashes) of each page with a host; lines inside an article do not take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", SLICE_BYTES):
                hashed = []
                for page in part.column("html").to_pylist():
                    lines, inside, _ = lines_of(page)
                    hashed.append([line_hash(x) for x, safe in zip(lines, inside, strict=True) if not safe])
                yield pa.RecordBatch.from_arrays(
                    [part.column("host"), part.column("path"), pa.array(hashed, pa.list_(pa.int64()))],
                    names=["host", "path", "lines"],
                )

    url = F.col("url").cast("string")
    rows = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html"))
    return rows.where("host != ''").mapInArrow(run, LINES)


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def _pairs(rows: Iterator[tuple[str, list[int]]], shared: list[tuple[str, list[int], list[int]]]) -> tuple | None:
    """Walk pages in order; add (host, lines, shared lines) for both of each pair of neighbours on a host."""
    last = None
    for host, lines in rows:
        if last and last[0] == host:
            a, b = np.array(last[1], np.int64), np.array(lines, np.int64)
            found = common(a, b)
            if found:
                same = sorted({int(a[i]) for i, _ in found})
                shared += [(host, last[1], same), (host, lines, same)]
        last = (host, lines)
    return last


#: edge: null, or 2 * partition for the first page of a partition, 2 * partition + 1 for its last.
SHARED = "host string, lines array<long>, shared array<long>, edge long, owner long"


def shared_lines(pages: DataFrame) -> DataFrame:
    """owner, shared: for each different sequence of lines of a host (its key), those that a neighbour also has.

    The order of paths is made by range partitioning, which splits a large host. The first and the last page of each
    partition are handed to a second, small step, which pairs the last of one with the first of the next.
    """
    different = page_lines(pages).groupBy("host", "lines").agg(F.min("path").alias("path"))
    ordered = different.repartitionByRange("host", "path", "lines").sortWithinPartitions("host", "path", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            rows = list(
                zip(*(batch.column(c).to_pylist() for c in ("host", "lines")), strict=True)
            )
            if not rows:
                continue
            if last is None:
                yield _shared_batch([(*rows[0], [], 2 * part)])
            shared: list = []
            _pairs(iter(([last] if last else []) + rows), shared)
            last = rows[-1]
            yield _shared_batch([(*s, None) for s in shared])
        if last is not None:
            yield _shared_batch([(*last, [], 2 * part + 1)])

    # the second step reads two rows per partition
    found = materialize(ordered.mapInArrow(run, SHARED))
    borders = found.where("edge is not null").select("edge", "host", "lines").repartition(1)

    def join_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("edge", "host", "lines")), strict=True)]
        yield _shared_batch([(*s, None) for s in border_pairs(rows)])

    across = borders.mapInArrow(join_borders, SHARED)
    pairs = found.where("edge is null").unionByName(across).select("owner", "shared")
    return pairs.groupBy("owner").agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared"))


def border_pairs(rows: list[tuple[int, str, list[int]]]) -> list[tuple[str, list[int], list[int]]]:
    """What the last page of each partition shares with the first of the next; rows of (edge, host, lines)."""
    shared: list = []
    rows = sorted(rows)  # first and last of a partition, then of the next
    for (_, *last), (_, *first) in zip(rows[1::2], rows[2::2]):
        _pairs(iter([tuple(last), tuple(first)]), shared)
    return shared


def _shared_batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [(*r, lines_key(r[0], r[1])) for r in rows]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64())
    names = ["host", "lines", "shared", "edge", "owner"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


PARTS = "page_id long, url string, key long, parts array<struct<text: string, line: long>>"


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, key of the page's lines, and the blocks that may belong to its text (line: null if protected)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("line", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "html", SLICE_BYTES):
                keys, parts = [], []
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    lines, inside, out = lines_of(page)
                    only = any(safe and not gone for safe, gone in zip(inside, out, strict=True))
                    hashed = [None if safe else line_hash(x) for x, safe in zip(lines, inside, strict=True)]
                    # a page whose text is protected needs no list; its key is its own and meets none
                    keys.append(lines_key(host, [h for h in hashed if h is not None]) if host and not only else None)
                    parts.append(
                        [
                            {"text": x, "line": h}
                            for x, h, gone in zip(lines, hashed, out, strict=True)
                            if not gone and (h is None or not only)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(keys, pa.int64()), pa.array(parts, kind)],
                    names=["page_id", "url", "key", "parts"],
                )

    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, PARTS)


def lines_key(host: str, lines: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(host.encode() + b"\0" + np.array(lines, np.int64).tobytes()) - (1 << 63)


TEXT = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages(page_id, url, html)."""
    shared = materialize(shared_lines(pages))
    parts = page_parts(pages)
    joined = parts.join(shared, F.coalesce(parts["key"], F.xxhash64("page_id", "url")) == shared["owner"], "left")
    kept = F.filter(
        "parts", lambda p: p["line"].isNull() | F.col("shared").isNull() | ~F.array_contains(F.col("shared"), p["line"])
    )
    text = F.array_join(F.transform(kept, lambda p: p["text"]), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read(spark, folder, "pages"))
