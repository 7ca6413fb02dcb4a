"""URL filter with redirect equivalence: block decisions reach the aliases of a page.

Every url is judged by the longest rule that fits it. A url without a rule takes the decision of
its alias class: the urls joined to it by redirect and canonical-link edges, over any number of
hops. An explicit allow goes first in both places: a url that a rule allows is never blocked
through an alias, and a class with an allowed member blocks none of its undecided members.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, no
aliases and the verdict allow. Repeated rows are judged alike. Extra columns are kept out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host, its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_key(url: Column) -> Column:
    """What urls of one resource share: no scheme, fragment, ``www.`` or ``m.``, tracking part or closing slash.

    Null for a null url and one without ``://``.
    """
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, r"(?:^|&)(?:utm_[^&]*|ref=[^&]*)", ""), "^&", "")
    key = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, key)


def resolve(base: Column, link: Column) -> Column:
    """The absolute form of a link found on the page ``base``."""
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    folder = F.concat(root, F.regexp_extract(F.concat(path_of(base), F.lit("")), r"(?s)^(.*/)?", 1))
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, link))
        .when((link == "") | link.startswith("#"), base)
        .when(link.startswith("?"), F.concat(root, path_of(base), link))
        .otherwise(F.concat(folder, link))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) urls: every canonical link and refresh redirect found in the pages' markup."""
    body = F.col(html)

    def links(tag: str, target: str) -> Column:
        tags = F.regexp_extract_all(body, F.lit(tag), F.lit(0))
        return F.transform(tags, lambda one: F.regexp_extract(one, target, 1))

    canonical = links(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]*)")
    redirect = links(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is);\s*url\s*=\s*[\"']?\s*([^\"'\s>]*)")
    found = pages.filter(F.col(url).isNotNull() & body.rlike(r"(?i)canonical|refresh")).select(
        F.col(url).alias("src"), F.explode(F.array_distinct(F.concat(canonical, redirect))).alias("link"),
    )
    return found.filter("link <> ''").select("src", resolve(F.col("src"), F.col("link")).alias("dst"))


def _rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    one = [
        F.struct(F.lit(r.host).alias("rule_host"), F.lit(r.path).alias("rule_path"), F.lit(r.verdict).alias("rule_verdict"))
        for r in rules
    ]
    empty = "array<struct<rule_host:string,rule_path:string,rule_verdict:string>>"
    return spark.range(1).select(F.inline(F.array(*one).cast(empty) if one else F.array().cast(empty)))


def apply_rules(urls: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``urls`` (host, path, ..) with ``rule`` and ``rule_verdict``, both null where no rule fits.

    The suffixes of the distinct hosts meet the rules in an equi-join, so neither the number of
    pages nor that of rules enters a product. The longest rule string wins, then the longer
    host, then allow.
    """
    table = rules if isinstance(rules, DataFrame) else _rule_table(urls.sparkSession, rules)
    labels = F.split("host", r"\.", -1)
    hosts = urls.select("host").filter("host <> ''").distinct().select(
        "host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("i"), labels.alias("labels")
    ).select("host", F.expr("array_join(slice(labels, i, size(labels)), '.')").alias("rule_host"))
    text = F.concat("rule_host", "rule_path")
    fitting = hosts.join(table, "rule_host").groupBy("host").agg(F.collect_set(F.struct(
        F.length(text).alias("size"), F.length("rule_host").alias("host_size"), (F.col("rule_verdict") == ALLOW).alias("allows"),
        F.col("rule_path").alias("path"), text.alias("rule"), F.col("rule_verdict").alias("verdict"),
    )).alias("fitting"))
    # Written, so that the join deals the pages out itself and can split a host with very many of them.
    fitting = stored(fitting, "url-host-rules")
    best = F.array_max(F.filter("fitting", lambda rule: F.col("path").startswith(rule["path"])))
    joined = urls.join(fitting, "host", "left").withColumn("best", best)
    return joined.select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def filter_urls(
    pages: DataFrame, rules: list[Rule] | DataFrame, edges: DataFrame | None = None, url: str = "url", html: str | None = "html",
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """One row per page: the kept columns, host, path, rule, verdict and decided_by (rule, alias or default).

    ``edges`` (src, dst) adds known redirects to the links found in the markup; ``html=None``
    reads no markup. Urls with one canonical key are one node, so a third of all pages on one
    url is one row in every step but the two joins that bring decisions to pages, which
    adaptive execution can split.
    """
    source = F.col(url)
    urls = pages.select(
        *[F.col(name) for name in keep], host_of(source).alias("host"), path_of(source).alias("path"),
        canonical_key(source).alias("node"),
    )
    judged = apply_rules(urls, rules)
    nodes = judged.filter("node is not null and rule_verdict is not null").groupBy("node").agg(
        F.max(F.col("rule_verdict") == BLOCK).alias("blocks"), F.max(F.col("rule_verdict") == ALLOW).alias("allows")
    )
    links = [link_edges(pages, url, html)] if html else []
    links += [edges.select("src", "dst")] if edges is not None else []
    if links:
        merged = links[0]
        for more in links[1:]:
            merged = merged.unionByName(more)
        classes = connected_components(
            merged.select(canonical_key(F.col("src")).alias("src"), canonical_key(F.col("dst")).alias("dst")), "url-classes"
        )
        # A link's ends carry the rules that fit their urls as they stand, also where they are no pages themselves.
        ends = merged.select(F.explode(F.array("src", "dst")).alias("url")).filter("url is not null").distinct()
        aliases = ends.select(canonical_key(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        aliases = aliases.filter("node is not null")
        by_rule = apply_rules(aliases, rules).filter("rule_verdict is not null").select(
            "node", (F.col("rule_verdict") == BLOCK).alias("blocks"), (F.col("rule_verdict") == ALLOW).alias("allows")
        )
        members = nodes.unionByName(by_rule).join(classes, "node", "left")
        decided = members.groupBy(F.coalesce("component", "node").alias("component")).agg(
            F.max("blocks").alias("blocks"), F.max("allows").alias("allows")
        ).filter("blocks and not allows")
        reach = classes.join(decided, "component", "left_semi").select("node").unionByName(
            decided.select(F.col("component").alias("node"))
        ).distinct()
    else:
        reach = nodes.filter("blocks and not allows").select("node")
    through = judged.join(reach.withColumn("reached", F.lit(True)), "node", "left")
    return through.select(
        *keep, "host", "path", "rule",
        F.when(F.col("rule_verdict").isNotNull(), F.col("rule_verdict")).when(F.col("reached"), BLOCK).otherwise(ALLOW).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("reached"), "alias").otherwise("default").alias("decided_by"),
    )
