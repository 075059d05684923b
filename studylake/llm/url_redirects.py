"""URL filter by redirect equivalence (native: DataFrame functions only).

Host and path rules judge a URL by themselves (the longest fitting rule wins;
allow wins a tie).  URLs that no rule fits take the decision of their aliases:
redirect and canonical-link edges join URLs to connected components, found
with distributed joins, and a component with an explicitly allowed URL is
allowed, else one with a blocked URL is blocked, else it is allowed.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits
no rule, has no aliases and is allowed.  Null HTML has no links.  Rows of an
empty table give an empty result.  Repeated rows are judged one by one.  Extra
columns are ignored.  A hot host needs no split: rules are judged inside a
row, and the only joins are on whole URLs against one row per URL.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import components, table, written


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str     # fits this host and its subdomains
    path: str     # fits paths that start so

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL's key as a graph node: lower-cased host, path and query, without scheme and fragment; null if no host."""
    key = F.concat(host_of(url), F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1))
    return F.when(F.length(host_of(url)) > 0, key)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def unescaped(t: Column) -> Column:
    """An attribute's value with &amp; and the numeric references of ASCII signs decoded, once."""
    parts = F.split(t, r"&(?=amp;|#[0-9]{1,7};|#[xX][0-9A-Fa-f]{1,6};)", -1)

    def sign(p: Column) -> Column:
        digits, hexed = F.regexp_extract(p, r"^#([0-9]{1,7});", 1), F.regexp_extract(p, r"^#[xX]([0-9A-Fa-f]{1,6});", 1)
        code = F.when(digits != "", digits.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        return (F.when(p.startswith("amp;"), F.concat(F.lit("&"), F.substring(p, 5, 2147483647)))
                .when((code > 32) & (code < 127), F.concat(F.char(code), F.regexp_replace(p, "^[^;]*;", "")))
                .otherwise(F.concat(F.lit("&"), p)))

    return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), sign), ""))


#: Parts of a page whose tags are no elements.
HIDDEN = "|".join([r"<!--.*?(?:-->|\z)", *(rf"<{t}\b.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "textarea", "title", "xmp", "iframe"))])
#: One attribute of a tag, with its value.
ATTRIBUTE = r"""[^\s=/"'>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
#: The target in the content of a refresh.
REFRESH = r"""(?is)^\s*[0-9]*(?:\.[0-9]*)?\s*[;,]?\s*url\s*=\s*["']?([^"'\s>]+)"""


def attribute(attributes: Column, name: str) -> Column:
    """The value of the first attribute ``name`` (null if none), of attributes as ATTRIBUTE finds them."""
    own = F.try_element_at(F.filter(attributes, lambda a: a.rlike(rf"(?is)^{name}\s*=")), F.lit(1))
    value = F.regexp_replace(own, rf"(?is)^{name}\s*=\s*", "")
    return F.regexp_replace(value, """(?s)^["'](.*)["']$""", "$1")


def _resolved(path: Column) -> Column:
    """A path without . and .. segments."""
    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array(F.lit("")), lambda acc, x: (
        F.when(x == ".", acc).when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).otherwise(F.concat(acc, F.array(x)))))
    end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.array_join(kept, "/"), end)).otherwise(path)


def page_links(html: Column, url: Column) -> Column:
    """Absolute URLs that canonical links and refresh redirects of a page name.

    Tags may run over several lines and hold > in quoted values; those in comments, scripts and other raw text do
    not count.  A reference is absolute if it starts with a scheme; . and .. segments are resolved.
    """
    seen = F.regexp_replace(html, f"(?is){HIDDEN}", " ")
    tags = F.regexp_extract_all(seen, F.lit(r"""(?is)<(?:link|meta)(?=[\s/>])(?:"[^"]*+"|'[^']*+'|[^'">]++)*+>"""), F.lit(0))

    def target(tag: Column) -> Column:
        own = F.regexp_extract_all(F.substring(tag, 6, 2147483647), F.lit(ATTRIBUTE), F.lit(0))
        rel = F.split(F.lower(F.trim(F.coalesce(attribute(own, "rel"), F.lit("")))), r"\s+")
        refresh = F.lower(F.trim(attribute(own, "http-equiv"))) == "refresh"
        return (F.when(tag.rlike("(?i)^<link") & F.array_contains(rel, "canonical"), F.trim(attribute(own, "href")))
                .when(tag.rlike("(?i)^<meta") & refresh, F.regexp_extract(attribute(own, "content"), REFRESH, 1)))

    root = F.regexp_extract(url, r"^([^:]*://[^/?#]*)", 1)
    page = F.regexp_extract(url, r"^([^:]*://[^/?#]*[^?#]*)", 1)
    folder = F.regexp_extract(url, r"^([^:]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)

    def absolute(t: Column) -> Column:
        return (F.when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), t)
                .when(t.startswith("//"), F.concat(F.lit("http:"), t))
                .when(t.startswith("/"), F.concat(root, t))
                .when(t.startswith("?"), F.concat(page, t))
                .when(folder == root, F.concat(root, F.lit("/"), t))
                .otherwise(F.concat(folder, t)))

    def plain(t: Column) -> Column:
        head, path = F.regexp_extract(t, r"^([^:]*://[^/?#]*)", 1), F.regexp_extract(t, r"^[^:]*://[^/?#]*(/[^?#]*)", 1)
        return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(head, _resolved(path), F.regexp_extract(t, r"([?#].*)$", 1))).otherwise(t)

    named = F.transform(F.transform(tags, target), lambda t: F.when(t.contains("&"), unescaped(t)).otherwise(t))
    return F.transform(F.transform(F.filter(named, lambda t: (F.length(t) > 0) & ~t.startswith("#")), absolute), plain)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url, html).

    ``redirects`` (src, dst: absolute URLs) adds edges that a crawler logged.
    """
    links = (pages.where(F.col("html").rlike(r"(?i)<(link|meta)\b"))
             .select(node_of(F.col("url")).alias("src"), F.explode(page_links(F.col("html"), F.col("url"))).alias("to"))
             .select("src", node_of(F.col("to")).alias("dst")))
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst")))
    links = written(links.where("src is not null and dst is not null and src != dst").distinct(), "redirects")
    own = F.concat(F.lit("://"), F.col("node"))
    members = components(links).withColumn("own", fitting_rule(host_of(own), path_of(own), rules)["verdict"])
    decided = members.groupBy("component").agg(F.max((F.col("own") == "allow").cast("int")).alias("allowed"),
                                               F.max((F.col("own") == "block").cast("int")).alias("blocked"))
    alias = members.join(decided, "component").select(
        "node", F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").otherwise("allow").alias("by_alias"))
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (judged.join(alias, "node", "left")
            .select("page_id", "host", "path", fit["rule"].alias("rule"),
                    F.coalesce(fit["verdict"], F.col("by_alias"), F.lit("allow")).alias("verdict")))


def op3_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _sql() -> str:
    """The same in SQL, apart from rules of Java's patterns: possessive repeats and look-ahead are not needed there."""
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def attr(name: str) -> str:
        value = f"regexp_replace(list_filter(own, lambda a: regexp_matches(a, '(?is)^{name}\\s*='))[1], '(?is)^{name}\\s*=\\s*', '')"
        return f"""regexp_replace({value}, {quoted("""(?s)^["'](.*)["']$""")}, '\\1')"""

    tag = quoted(r"""(?is)<(?:link|meta)(?:[\s/](?:"[^"]*"|'[^']*'|[^'">]+)*)?>""")
    code = "CASE WHEN regexp_matches(x, '^#[0-9]{1,7};') THEN CAST(regexp_extract(x, '^#([0-9]{1,7});', 1) AS INTEGER) WHEN regexp_matches(x, '^#[xX][0-9A-Fa-f]{1,6};') THEN CAST('0x' || regexp_extract(x, '^#[xX]([0-9A-Fa-f]{1,6});', 1) AS INTEGER) END"
    sign = f"CASE WHEN starts_with(x, 'amp;') THEN '&' || substr(x, 5) WHEN ({code}) > 32 AND ({code}) < 127 THEN chr({code}) || regexp_replace(x, '^[^;]*;', '') ELSE '&' || x END"
    return rf"""
with recursive p as (
  select page_id, url, html,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(url, '://[^/?#]*([^#]*)', 1), '') as rest
  from pages),
g as (select host, rest, regexp_extract(url, '^([^:]*://[^/?#]*)', 1) as root, regexp_extract(url, '^([^:]*://[^/?#]*[^?#]*)', 1) as page,
    regexp_extract(url, '^([^:]*://[^/?#]*(?:/[^?#]*/|/)?)', 1) as folder,
    unnest(regexp_extract_all(regexp_replace(html, {quoted("(?is)" + HIDDEN)}, ' ', 'g'), {tag})) as tag
  from p where host <> '' and regexp_matches(html, '(?i)<(link|meta)\b')),
o as (select *, regexp_extract_all(substr(tag, 6), {quoted(ATTRIBUTE)}) as own from g),
h as (select *, case when regexp_matches(tag, '(?i)^<link') and list_contains(string_split_regex(lower(trim(coalesce({attr("rel")}, ''))), '\s+'), 'canonical') then trim({attr("href")})
    when regexp_matches(tag, '(?i)^<meta') and lower(trim({attr("http-equiv")})) = 'refresh' then regexp_extract({attr("content")}, {quoted(REFRESH)}, 1) end as raw from o),
t as (select *, string_split(raw, '&')[1] || coalesce(array_to_string(list_transform(string_split(raw, '&')[2:], lambda x: {sign}), ''), '') as lnk from h where raw <> '' and not starts_with(raw, '#')),
a as (select host || rest as src, case when regexp_matches(lnk, '^[A-Za-z][A-Za-z0-9+.-]*:') then lnk when starts_with(lnk, '//') then 'http:' || lnk
    when starts_with(lnk, '/') then root || lnk when starts_with(lnk, '?') then page || lnk when folder = root then root || '/' || lnk else folder || lnk end as u from t),
d as (select src, u, regexp_extract(u, '^[^:]*://[^/?#]*(/[^?#]*)', 1) as path from a),
r as (select src, case when regexp_matches(path, '/\.\.?(?:/|$)') then regexp_extract(u, '^([^:]*://[^/?#]*)', 1)
    || array_to_string(list_reduce(list_transform(string_split(path, '/'), lambda s: [s]), lambda acc, x: case when x[1] = '.' then acc when x[1] = '..' then (case when len(acc) > 1 then acc[1:len(acc) - 1] else acc end) else list_concat(acc, x) end), '/')
    || case when regexp_matches(path, '/\.\.?$') then '/' else '' end || regexp_extract(u, '([?#].*)$', 1) else u end as u from d),
e as (select src, lower(regexp_extract(u, '://([^/?#]*)', 1)) || regexp_extract(u, '://[^/?#]*([^#]*)', 1) as dst from r where regexp_extract(u, '://([^/?#]*)', 1) <> ''),
both_ways as (select src, dst from e union select dst, src from e),
reach as (select src as node, src as other from both_ways union select r.node, b.dst from reach r join both_ways b on r.other = b.src),
rules(verdict, h, pre) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
n as (select distinct other, regexp_extract(other, '^([^/?#]*)', 1) as host, regexp_extract(other, '^[^/?#]*([^?#]*)', 1) as path from reach),
nr as (select n.other, arg_max(r.verdict, length(h) + length(pre)) as v from n join rules r on (n.host = h or ends_with(n.host, '.' || h)) and starts_with(n.path, pre) group by 1),
alias as (select node, case when bool_or(v = 'allow') then 'allow' when bool_or(v = 'block') then 'block' else 'allow' end as v from reach join nr on reach.other = nr.other group by 1),
own as (select d.host, d.path, arg_max(h || pre, length(h) + length(pre)) as rule, arg_max(r.verdict, length(h) + length(pre)) as v
  from (select distinct host, path from p) d join rules r on (d.host = h or ends_with(d.host, '.' || h)) and starts_with(d.path, pre) group by 1, 2)
select p.page_id, p.host, p.path, own.rule, coalesce(own.v, alias.v, 'allow') as verdict
from p left join own on p.host = own.host and p.path = own.path left join alias on p.host <> '' and p.host || p.rest = alias.node
"""


SQL = _sql()
