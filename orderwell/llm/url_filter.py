"""URL filters: rules by host and path, and block decisions that follow redirects and canonical links.

Method. Every page is a node, its url without scheme and fragment. A canonical link or an immediate refresh in its html
is an edge to another url; a table of redirects gives more. Connected components of these edges (rounds of joins) are
groups of aliases. A url with a rule of its own is judged by it. Any other url is judged by its group: allowed if a url of
the group has an allow rule (an explicit allow takes precedence), else blocked if one has a block rule, else allowed.

A rule names a host and a beginning of a path; it fits that host and its subdomains, and the longest rule wins.

Rows: one per page, also for repeated rows. A null url, or one without ://, has empty host and path, fits no rule and has
no edges. Null html has no links. References are resolved as RFC 3986 says, against the page's `base` if it has one, else
its url; `canonical` may be any of a link's rel tokens.
"""

from __future__ import annotations

import html as markup
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import arrow_map, read
from orderwell.llm.components import connected_components
from orderwell.session import materialize

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _after_scheme(url: F.Column) -> F.Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: F.Column) -> F.Column:
    host = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: F.Column) -> F.Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: F.Column) -> F.Column:
    """The url without scheme and fragment, host lower-cased; null without a host."""
    rest = F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


#: A whole tag; quoted values may hold < and >. As no reading passes a < outside quotes, a page is read in linear time.
INSIDE = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TAG = re.compile(rf"<(?:link|meta|base)\b{INSIDE}>", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
GOES_TO = re.compile(r"\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?(?:\"([^\"]*)\"?|'([^']*)'?|(.*))", re.IGNORECASE | re.DOTALL)
#: RFC 3986, appendix B: scheme, authority, path, query; a fragment is left out.
PARTS = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?", re.DOTALL)


def without_dots(path: str) -> str:
    """RFC 3986, 5.2.4."""
    out: list[str] = []
    parts = path.split("/")
    for part in parts:
        if part == "..":
            if len(out) > 1 or (out and out[0]):
                out.pop()
        elif part != ".":
            out.append(part)
    if parts[-1] in (".", ".."):
        out.append("")
    return "/".join(out)


def resolved(target: str | None, base: str | None) -> str | None:
    """The url a reference names (RFC 3986, 5.2.2), without fragment; null if it has no scheme:// in the end."""
    if target is None or base is None:
        return None
    scheme, host, path, query = PARTS.match(target.strip()).groups()
    if scheme is None:
        scheme, base_host, base_path, base_query = PARTS.match(base.strip()).groups()
        if host is None:
            host = base_host
            if not path:
                path, query = base_path, base_query if query is None else query
            elif not path.startswith("/"):
                path = base_path[: base_path.rfind("/") + 1] + path if base_path else "/" + path
    if scheme is None or host is None:
        return None
    return f"{scheme}://{host}{without_dots(path)}" + ("" if query is None else f"?{query}")


def attributes(tag: str) -> dict[str, str]:
    """The values of a tag by lower-cased name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(tag[tag.find("<") + 1 :]):
        out.setdefault(name.lower(), markup.unescape(a or b or c))
    return out


def target_of(tag: str) -> str | None:
    """What a canonical link or a refresh names."""
    at = attributes(tag)
    if tag[:5].lower() == "<link":
        return at.get("href") if "canonical" in at.get("rel", "").lower().split() else None
    if at.get("http-equiv", "").strip().lower() != "refresh":
        return None
    return next((x.strip() for x in GOES_TO.match(at.get("content", "")).groups() if x and x.strip()), None)


def targets(html: str, url: str | None) -> list[str]:
    """The urls a page at `url` names as canonical or refreshes to."""
    tags = TAG.findall(html)
    first_base = next((t for t in tags if t[:5].lower() == "<base"), None)
    base = (resolved(attributes(first_base).get("href"), url) if first_base else None) or url
    found = (resolved(target_of(t), base) for t in tags if t[:5].lower() != "<base")
    return [t for t in found if t is not None]


def link_edges(pages: DataFrame) -> DataFrame:
    """a, b: nodes of the pages and of what they name as canonical or refresh to at once."""

    def setup():
        def work(batch: pa.RecordBatch) -> dict:
            rows = zip(batch.column("html").to_pylist(), batch.column("url").to_pylist(), strict=True)
            return {"url": batch.column("url"), "named": [targets(html, url) for html, url in rows]}

        return work

    html = F.col("html").cast("string")
    linked = pages.select(F.col("url").cast("string").alias("url"), html.alias("html"))
    linked = linked.where(html.ilike("%canonical%") | html.ilike("%refresh%"))
    edges = arrow_map(linked, setup, "url string, named array<string>", text="html").select("url", F.explode("named").alias("named"))
    return edges.select(node_of(F.col("url")).alias("a"), node_of(F.col("named")).alias("b"))


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of pages(page_id, url, html); redirects(source, target) are urls."""
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")))
    groups = materialize(connected_components(edges))
    node = F.concat(F.lit("x://"), F.col("node"))
    own = rule_of(host_of(node), path_of(node), rules)["verdict"]
    judged = groups.withColumn("own", own).groupBy("component").agg(
        F.when(F.max(F.col("own") == "allow"), "allow").when(F.max(F.col("own") == "block"), "block").alias("group_verdict")
    )
    aliases = materialize(
        groups.join(judged, "component").where("group_verdict is not null").select("node", "group_verdict")
    )
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).join(aliases, "node", "left")
    verdict = F.coalesce(F.col("found.verdict"), F.col("group_verdict"), F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read(spark, folder, "pages"))


#: The rules as the contract states them, and verdicts of alias groups: reachability over canonical links and refreshes
#: whose tags stand in their usual form (double quotes, absolute urls).
OP7_SQL = r"""
WITH RECURSIVE page AS (
    SELECT page_id, html, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM (SELECT page_id, coalesce(CAST(html AS VARCHAR), '') AS html, coalesce(CAST(url AS VARCHAR), '') AS url FROM pages)
), parts AS (
    SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1, 's') AS tail
    FROM page
), named AS (
    SELECT page_id, host, path, html, CASE WHEN host <> '' THEN host || CASE WHEN tail = '' THEN '/' ELSE tail END END AS node FROM parts
), target AS (
    SELECT node AS a, unnest(regexp_extract_all(html, '<link rel="canonical" href="[a-z]+://([^"#]+)', 1)
        || regexp_extract_all(html, '<meta http-equiv="refresh" content="[0-9]+; ?url=[a-z]+://([^"#]+)', 1)) AS b
    FROM named WHERE node IS NOT NULL
), edge AS (
    SELECT a, lower(regexp_extract(b, '^[^/?]*')) || CASE WHEN regexp_extract(b, '^[^/?]*(.*)', 1) = '' THEN '/'
        ELSE regexp_extract(b, '^[^/?]*(.*)', 1) END AS b FROM target
), linked AS (
    SELECT a, b FROM edge UNION SELECT b, a FROM edge
), reach AS (
    SELECT a, a AS b FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), rules(verdict, name, start) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), place AS (
    SELECT DISTINCT host, path FROM named UNION SELECT regexp_extract(b, '^[^/?]*'), regexp_extract(b, '^[^/?]*([^?]*)', 1) FROM reach
), ruled AS (
    SELECT host, path, arg_max(verdict, length(name || start)) AS verdict, arg_max(name || start, length(name || start)) AS rule
    FROM place JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
    GROUP BY host, path
), grouped AS (
    SELECT a AS node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
    FROM reach LEFT JOIN ruled ON host = regexp_extract(b, '^[^/?]*') AND path = regexp_extract(b, '^[^/?]*([^?]*)', 1)
    GROUP BY a
)
SELECT n.page_id, n.host, n.path, r.rule, coalesce(r.verdict, g.verdict, 'allow') AS verdict
FROM named n LEFT JOIN ruled r ON n.host = r.host AND n.path = r.path LEFT JOIN grouped g ON n.node = g.node
"""
