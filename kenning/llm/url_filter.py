"""URL filter: rules, and for the pages no rule fits a host's standing in the link graph.

Rules name a host (all its subdomains included) and the start of a path; the longest
rule that fits judges the page. Pages judged by rules are the seeds of two personalised
PageRanks over the host graph (an edge per pair of hosts that link, weighted by the
number of links): trust starts at the hosts of allowed pages and follows the links,
distrust starts at those of blocked pages and follows the links backwards, so who links
to blocked hosts is distrusted too. A host with more than ``BLOCK_SHARE`` of its
standing from distrust is blocked, any other allowed, one that neither reaches as well.

Both ranks are one table (kind, host, mass) that is pushed along the edges: each step
is a join on the host and a sum by target, and what a step moves is written to the
shared folder; the ranks are the sum of the steps. A step moves ``DAMPING`` of the last
at most, so ``STEPS`` leave out less than ``DAMPING ** STEPS`` (1e-4) of the whole;
mass that reaches a host without links ends there. A host that links to very many
others has its edges in slots of about ``SLOT`` and its mass sent to each slot, so no
task holds all its edges; links are counted per page and summed map-side before they
are shuffled. Only the number of rows a step moves reaches the driver. All of it is
DataFrame functions.

Links are the ``href`` of ``a`` and ``area`` tags outside comments, scripts and styles,
with a scheme or ``//``; those without name the own host, and links of a host to itself
move nothing.

Defined results: a null url or one without ``://`` has empty host and path, fits no
rule, takes no part in the graph and is allowed; a null page has no links; of equally
long rules the one that sorts last wins; rows that repeat are each returned and count
as pages of their own; an empty table gives an empty result; other columns are ignored,
whatever their names; texts of any length are read whole.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch

DAMPING = 0.85
STEPS = math.ceil(math.log(1e-4) / math.log(DAMPING))
BLOCK_SHARE = 0.5
SLOT = 100_000
# A host's pages meet its rank in that many tasks.
SPREAD = 16
# Parts of a page without links, an opening tag that links (quoted values may hold <
# and >; the loops give nothing back, so the work is linear), the host it names.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
LINK_TAG = r"""(?i)<(?:a|area)[\s/](?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
LINK_HOST = r"""(?is)^<\w+[\s/](?:.*?[\s"'/])?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s]*)"""
# (verdict, host, start of the path)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, null if none."""
    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    told = F.array(*[F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
                              F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    fits = F.filter(told, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["length"].alias("length"), best["rule"].alias("rule"),
                                             best["verdict"].alias("verdict")))


def host_links(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """(src, dst, n): links between different hosts, counted. Comments, scripts and
    styles are cut out first; every pattern is linear in the text."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    tags = F.regexp_extract_all(bare, F.lit(LINK_TAG), F.lit(0))
    dst = F.translate(F.regexp_extract("tag", LINK_HOST, 1), string.ascii_uppercase, string.ascii_lowercase)
    return (pages.select(host.alias("src"), F.explode(tags).alias("tag"))
            .where((F.col("src") != "") & F.contains("tag", F.lit("//")))
            .select("src", dst.alias("dst")).where((F.col("dst") != "") & (F.col("dst") != F.col("src")))
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def rank_edges(links: DataFrame, slot: int = SLOT) -> DataFrame:
    """(kind, host, slot, to, share): both directions, a host's shares adding up to one
    in each, with its edges dealt to slots."""
    both = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    sums = both.groupBy("kind", "host").agg(F.sum("n").alias("all_n"), F.count("*").alias("n_to"))
    return (both.join(sums, ["kind", "host"])
            .select("kind", "host", F.pmod(F.xxhash64("to"), F.ceil(F.col("n_to") / slot)).alias("slot"), "to",
                    (F.col("n") / F.col("all_n")).alias("share")))


def host_ranks(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS, slot: int = SLOT) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches. ``links``: (src, dst,
    n); ``seeds``: (host, trust, distrust), any weights, brought to a sum of one each."""
    edges = scratch(rank_edges(links, slot), "host-edges")
    whole = dict(zip(("trust", "distrust"), seeds.agg(F.sum("trust"), F.sum("distrust")).first()))  # two numbers
    mass = scratch(
        seeds.select("host", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(k) / F.lit(w or 1.0)).alias("mass"))
                                                 for k, w in whole.items()])).alias("s"))
        .select("s.kind", "host", "s.mass").where("mass > 0"), "rank")
    slots = edges.groupBy("kind", "host").agg(F.max("slot").alias("last"))
    moved = [mass]
    for _ in range(steps):
        sent = (moved[-1].join(slots, ["kind", "host"])
                .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))))
        step = scratch(sent.join(edges, ["kind", "host", "slot"])
                       .groupBy("kind", F.col("to").alias("host"))
                       .agg((F.sum(F.col("mass") * F.col("share")) * damping).alias("mass")), "rank")
        if step.isEmpty():
            break
        moved.append(step)
    total = moved[0]
    for step in moved[1:]:
        total = total.unionByName(step)
    part = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")}
    return total.groupBy("host").agg(*part.values())


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               block_share: float = BLOCK_SHARE) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (null if none fits),
    ``verdict`` and the host's ``trust`` and ``distrust`` (0 where neither reaches)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    best = longest_rule(F.col("host"), F.col("path"), rules)
    judged = scratch(src.select("id", host.alias("host"), path.alias("path")).withColumn("best", best)
                     .select("id", "host", "path", "best.rule", "best.verdict"), "judged")
    seeds = judged.where(F.col("verdict").isNotNull()).groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("verdict") == "block").cast("double").alias("distrust"))
    ranks = host_ranks(host_links(src, host, F.col("html")), seeds)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    zero = F.lit(0.0)
    # a host may have a third of all pages: they are dealt to SPREAD tasks, its one rank to each
    ranks = ranks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    judged = judged.withColumn("part", F.pmod(F.hash("id", "path"), F.lit(SPREAD)))
    return (judged.join(ranks, ["host", "part"], "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("verdict", F.when(share > block_share, "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust")))
