"""URL filter: host and path rules, and link-graph propagation for what no rule fits.

A rule fits its host and all subdomains if the path starts with the rule's path; the
longest fitting rule decides.  For the rest, hosts that hold allowed pages are trusted
seeds and hosts that hold blocked pages are distrusted ones, in proportion to their
pages.  Trust flows along host links (personalised PageRank from the trusted seeds);
distrust flows against them, since a host that links to a blocked one is suspect.  A host
is blocked if its distrusted mass is more than ``DISTRUST_SHARE`` of both.

Scale.  Pages are first summed per host and per host pair, with partial aggregates, so a
host with a third of all pages is one row per task.  The rounds run over distinct edges;
each round's ranks are stored, which cuts lineage, and rounds end when the ranks stand
still.  The last join gives pages their host's verdict: hosts without any distrust need
no row, so only suspect hosts are joined.

Cases.  A null url, or one without ``://``, has empty host and path, fits no rule, and is
allowed unless hosts' ranks say otherwise.  Null or empty html has no links.  Links to
the page's own host count for nothing.  Repeated rows are judged row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, store

# The contract's rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
DISTRUST_SHARE = 0.5
#: Rank is passed on until less than this is left on its way.
STILL = 1e-6

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, host: str, html: str = "html") -> DataFrame:
    """Distinct links between hosts (src, dst, n pages)."""
    to = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER)))
    links = pages.where(F.col(html).rlike(_LINK)).select(F.col(host).alias("src"), F.explode(to).alias("dst"))
    return links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, still: float = STILL) -> DataFrame:
    """Personalised PageRank: ``seeds`` (host, s), with s summing to one or empty;
    ``links`` (src, dst, n).  What ranks at hosts without links goes back to the seeds.
    Returns (host, r) for hosts with rank.

    The fixed point r = (1 - damping m) s + damping W r, m being the rank at hosts with
    links, is a multiple of s + damping W s + (damping W)^2 s + ..., so these terms are
    added up, until one holds less than ``still``, and made to sum to one.  A term holds
    at most ``damping`` of the one before it, which bounds the rounds."""
    out = links.groupBy("src").agg(F.sum("n").alias("of"))
    edges = store(links.join(out, "src").select("src", "dst", (F.col("n") / F.col("of")).alias("w")), "edges")
    term = seeds.select("host", F.col("s").alias("r"))
    if edges.isEmpty():
        return term
    terms = [term]
    while True:
        term = store(edges.join(term, edges.src == term.host).groupBy(F.col("dst").alias("host")).agg(F.sum(damping * F.col("r") * F.col("w")).alias("r")), "term")
        left = term.agg(F.sum("r")).first()[0] or 0.0
        if left < still:
            break
        terms.append(term)
        if len(terms) > 16:  # added up now and then, so that plans stay short
            terms = [_added(terms)]
    rank = _added(terms)
    total = rank.agg(F.sum("r")).first()[0] or 1.0
    return rank.select("host", (F.col("r") / total).alias("r"))


def _added(terms: list[DataFrame]) -> DataFrame:
    return store(reduce(DataFrame.unionByName, terms).groupBy("host").agg(F.sum("r").alias("r")), "ranks")


def _seeds(hosts: DataFrame, count: str, total: float) -> DataFrame:
    return hosts.where(F.col(count) > 0).select("host", (F.col(count) / (total or 1.0)).alias("s"))


def suspect_hosts(pages: DataFrame, host: str, verdict: str, html: str = "html") -> DataFrame:
    """Hosts (host, trust, distrust) whose distrusted mass exceeds the share allowed."""
    marks = pages.where(F.col(host) != "").groupBy(F.col(host).alias("host")).agg(
        F.sum((F.col(verdict) == "allow").cast("double")).alias("n_allow"), F.sum((F.col(verdict) == "block").cast("double")).alias("n_block")
    )
    marks = store(marks.where("n_allow > 0 or n_block > 0"), "marks")
    total = marks.agg(F.sum("n_allow").alias("allow"), F.sum("n_block").alias("block")).first()
    links = store(host_links(pages, host, html), "links")
    trust = propagate(_seeds(marks, "n_allow", total["allow"]), links)
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(_seeds(marks, "n_block", total["block"]), back)
    both = distrust.withColumnRenamed("r", "d").join(trust.withColumnRenamed("r", "t"), "host", "left")
    d = F.col("d") * (total["block"] or 0.0)
    t = F.coalesce("t", F.lit(0.0)) * (total["allow"] or 0.0)
    return both.select("host", t.alias("trust"), d.alias("distrust")).where(F.col("distrust") > DISTRUST_SHARE * (F.col("trust") + F.col("distrust")))


def judge(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html") -> DataFrame:
    """All columns of ``pages`` plus ``host``, ``path``, ``rule`` and ``verdict`` (under
    other names, with underscores added, where ``pages`` has such columns)."""
    host, path, rule, verdict = (fresh(pages, c) for c in ("host", "path", "rule", "verdict"))
    fit = fresh(pages, "fit")
    known = pages.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})
    known = known.withColumn(fit, rule_of(F.col(host), F.col(path), rules)).withColumns({rule: F.col(f"{fit}.rule"), verdict: F.col(f"{fit}.verdict")}).drop(fit)
    suspects = store(suspect_hosts(known, host, verdict, html), "suspects").select(F.col("host").alias(fit))
    joined = known.join(suspects, F.col(host) == F.col(fit), "left")
    decided = F.coalesce(F.col(verdict), F.when(F.col(fit).isNotNull(), "block").otherwise("allow"))
    return joined.withColumn(verdict, decided).select(*pages.columns, host, path, rule, verdict)


def report(pages: DataFrame) -> DataFrame:
    """The query's result: host, path, rule and verdict of every page."""
    return judge(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")
