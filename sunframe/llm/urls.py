"""URL filters: rules by host and path, and redirect equivalence.

URLs that redirect to each other or name one another as canonical are aliases. Connected components
over those edges carry block decisions to every alias; a URL's own rule comes first, so an explicit
allow is never overruled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.llm.common import spread_join, table, written
from sunframe.llm.components import connected_components

#: Verdict and rule (host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Rules that are written into one expression; more, or a table of them, are joined.
SHORT = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host."""
    return F.coalesce(F.regexp_extract(url, _HOST, 2), F.lit(""))


def _first_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule of a short list that fits, and its verdict; of equal ones an allow comes first."""
    rule = verdict = None
    for what, text in sorted(rules, key=lambda r: (-len(r[1]), r)):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _rule_table(rules: DataFrame) -> DataFrame:
    """``own, prefix, rule, what``: each rule once, an allow before a block; null rules and verdicts are none."""
    rows = rules.select(F.col("verdict").cast("string").alias("what"), F.col("rule").cast("string").alias("rule")).na.drop()
    own = F.substring_index("rule", "/", 1)
    rows = rows.groupBy("rule").agg(F.min("what").alias("what"))
    return rows.select(own.alias("own"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("prefix"), "rule", "what")


def ruled(rows: DataFrame, rules) -> DataFrame:
    """``rows`` (with ``host`` and ``path``) and the ``rule`` that fits each best and its verdict, ``own``; null without one.

    A short list is one expression. Others are a table: each distinct host is looked up by its suffixes
    for the lengths of paths that its rules have, each distinct URL then by the heads of its path of these
    lengths, so that the work of a URL does not grow with the number of rules.
    """
    if not isinstance(rules, DataFrame):
        rules = list(rules)
        if len(rules) <= SHORT:
            rule, own = _first_rule(F.col("host"), F.col("path"), rules)
            return rows.withColumns({"rule": rule, "own": own})
        rules = rows.sparkSession.createDataFrame([(what, text) for what, text in rules], "verdict string, rule string")
    listed = written(_rule_table(rules), "url-rules")
    lengths = listed.select("own", F.length("prefix").alias("n")).distinct()
    rows = written(rows, "url-rows")
    named = rows.select("host", "path").distinct()
    hosts = named.select("host").distinct()
    suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split("host", r"\."))), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    asked = written(hosts.select(F.col("host").alias("of"), F.explode(suffixes).alias("suffix")), "url-suffixes")
    met = spread_join(asked, lengths, {"suffix": "own"}).select("of", "suffix", "n")
    met = met.groupBy("of").agg(F.collect_set(F.struct("suffix", "n")).alias("tries"))  # labels of a host by lengths of paths
    urls = spread_join(written(named, "url-named"), met, {"host": "of"}).select("host", "path", F.explode("tries").alias("t"))
    heads = urls.filter(F.length("path") >= F.col("t.n")).select("host", "path", F.col("t.suffix").alias("suffix"), F.expr("substring(path, 1, t.n)").alias("head"))
    hits = spread_join(written(heads, "url-heads"), listed, {"suffix": "own", "head": "prefix"})
    best = hits.groupBy("host", "path").agg(F.min(F.struct(-F.length("rule"), "what", "rule")).alias("b"))
    best = best.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("b.rule").alias("rule"), F.col("b.what").alias("own"))
    return spread_join(rows, best, {"host": "h", "path": "p"}, "left").drop("h", "p")


def node_of(url: Column) -> Column:
    """What stands for a URL in the graph: scheme and host in lower case, ``/`` for an empty path, no empty query, no fragment; null without a host."""
    bare = F.regexp_replace(url, r"(?s)#.*", "")
    scheme = F.translate(F.regexp_extract(bare, r"(?s)^\s*(.*?)://", 1), _UPPER, _LOWER)
    path, query = path_of(bare), F.regexp_extract(bare, r"(?s)(\?.+)$", 1)
    node = F.concat(scheme, F.lit("://"), host_of(bare), F.when(path == "", "/").otherwise(path), query)
    return F.when(host_of(bare) != "", node)


_TAG = re.compile(r"<(?:link|meta)\b[^>]*>", re.IGNORECASE)
_CANONICAL = re.compile(r"""<link\b[^>]*\srel\s*=\s*["']?[^"'>]*\bcanonical\b""", re.IGNORECASE)
_REFRESH = re.compile(r"""<meta\b[^>]*\shttp-equiv\s*=\s*["']?\s*refresh\b""", re.IGNORECASE)
_HREF = re.compile(r"""\shref\s*=\s*["']?([^"'>\s]*)""", re.IGNORECASE)
_GOES_TO = re.compile(r"""\burl\s*=\s*["']?([^"'>\s]*)""", re.IGNORECASE)


def links_of(url: str, html: str) -> list[str]:
    """Absolute URLs that a page names as canonical or refreshes to."""
    out = []
    for tag in _TAG.findall(html):
        for kind, place in ((_CANONICAL, _HREF), (_REFRESH, _GOES_TO)):
            found = place.search(tag) if kind.match(tag) else None
            if found and found[1]:
                try:
                    out.append(urljoin(url, unescape(found[1])))
                except ValueError:  # a link that is no URL
                    continue
    return out


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = [(url, link) for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for link in links_of(url, html)]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], ["source", "target"])


def alias_edges(pages: DataFrame) -> DataFrame:
    """``a, b``: a page's node and the node that its canonical link or meta refresh names."""
    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    # Only pages that hold such a tag leave the JVM.
    some = rows.filter(F.col("url").contains("://") & F.col("html").rlike(r"(?i)<(?:link|meta)\b[^>]*(?:canonical|refresh)"))
    return _edges(some.mapInArrow(_named, "source string, target string"))


def _edges(pairs: DataFrame) -> DataFrame:
    both = pairs.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b"))
    return both.filter("a is not null and b is not null and a <> b")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    A page's own rule decides. A page without one is blocked if any URL of its component, on the table
    or only named by a link, is blocked by a rule; else it is allowed. ``rules`` are (verdict, rule) pairs
    or a table with columns ``verdict`` and ``rule``, of any number; of equal rules an allow comes first.
    ``redirects`` (``source``, ``target``) adds observed redirects to the links that pages hold. Null URLs
    and those without ``://`` have no host, no rule and no aliases, and are allowed; null pages name no
    aliases; long URLs and pages are read whole. Rows with null or repeated ids are judged by their URL,
    repeated rows each stay, other columns do not matter, and an empty table gives no rows.
    """
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(_edges(redirects.select(F.col("source").cast("string"), F.col("target").cast("string"))))
    found = connected_components(edges)
    judged = ruled(found.select("node", "root", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    judged = written(judged.select("node", "root", "own"), "url-nodes")
    blocked = written(judged.filter("own = 'block'").select(F.col("root").alias("bad")).distinct(), "url-blocked")
    aliases = written(spread_join(judged, blocked, {"root": "bad"}).select(F.col("node").alias("alias")), "url-aliases")
    url = F.col("url").cast("string")
    rows = ruled(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")), rules)
    # An alias counts only for a page without a rule; a node stands once in ``aliases``.
    joined = rows.join(aliases, F.when(F.col("own").isNull(), F.col("node")) == F.col("alias"), "left")
    spread = F.when(F.col("alias").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("own", spread).alias("verdict"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages hold no canonical link and no refresh: there verdicts come from the rules alone."""
    return judge(table(spark, sf_dir, "pages"))


#: The same in DuckDB: links with an absolute or root-relative target, closed by recursion.
OP9_SQL = r"""
with recursive page as (
  select page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
link as (
  select url, unnest(list_concat(
      regexp_extract_all(html, '(?is)<link\b[^>]*\srel\s*=\s*["'']?canonical["'']?[^>]*\shref\s*=\s*["'']?([^"''>\s]*)', 1),
      regexp_extract_all(html, '(?is)<meta\b[^>]*\shttp-equiv\s*=\s*["'']?refresh[^>]*\burl\s*=\s*["'']?([^"''>\s]*)', 1))) as target
  from pages where url like '%://%'),
pair as (
  select url as source, case when target like '/%' then regexp_extract(url, '^[^/]*//[^/?#]*') || target else target end as target
  from link where target like '/%' or target like '%://%'),
ends as (select unnest([source, target]) as url from pair),
named as (
  select distinct url, regexp_replace(url, '(?s)#.*', '') as bare from ends),
node as (
  select url, bare,
    translate(coalesce(regexp_extract(bare, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(bare, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from named),
edge as (
  select a.bare as a, b.bare as b from pair join node a on a.url = pair.source join node b on b.url = pair.target
  union select b.bare, a.bare from pair join node a on a.url = pair.source join node b on b.url = pair.target),
reach(node, other) as (
  select a, a from edge union select r.node, e.b from reach r join edge e on e.a = r.other),
bad as (
  select distinct r.node from reach r join node n on n.bare = r.other
  where case
    when (n.host = 'example.org' or n.host like '%.example.org') and starts_with(n.path, '/en/1') then true
    when (n.host = 'example.org' or n.host like '%.example.org') and starts_with(n.path, '/es/') then true
    when (n.host = 'com' or n.host like '%.com') and starts_with(n.path, '/de/') then true
    else false end),
judged as (
  select page_id, url, host, path, case
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule
  from page)
select page_id, host, path, rule, case
    when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block'
    when rule is not null then 'allow'
    when regexp_replace(url, '(?s)#.*', '') in (select node from bad) then 'block'
    else 'allow' end as verdict
from judged
"""
