"""URL filter: rules for hosts and paths, and link-graph propagation for what no rule decides; DataFrame
functions only.

A rule is a host with a path prefix. It fits that host and its subdomains if the path starts with its path;
the longest fitting rule decides. Rules are matched per distinct host (by the host's suffixes, one equi-join),
so a page only filters its host's few rules by path.

Other pages get their host's verdict. Trust is personalised PageRank over the links between hosts, restarted
at hosts with allowed pages; distrust is the same over reversed links, restarted at hosts with blocked pages
(who links to the blocked is suspect). A host also exchanges links with its parent domain. A host whose
distrust exceeds ``threshold`` times its trust is blocked. Links are counted per pair of hosts before the
shuffle; each round joins the edges with the ranks by source host (adaptive execution splits a hot host) and
sums partially before the shuffle. Ranks are checkpointed every few rounds. The rounds
go on until every host that a seed reaches has been reached and the ranks change by at most ``tolerance`` in sum, so a
verdict does not depend on how many rounds there were: a host any number of links from a blocked one is judged.

Defined cases: a null url, or one without "://", has an empty host and path, fits no rule and is allowed;
null html has no links; an empty path does not start with "/"; rows that repeat are judged one by one but
weigh in the seeds and links; without seeds nothing is blocked; extra columns are not read; empty tables
give empty results; of rules of equal length a block wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)"""
TOLERANCE, DAMPING, CHECKPOINT_EVERY = 1e-3, 0.85, 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and every parent domain."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def host_rules(hosts: DataFrame, rules: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """(host, rules): the rules of every host that has some."""
    side = F.broadcast(rules) if rules.limit(broadcast_rows + 1).count() <= broadcast_rows else rules
    return (hosts.select(F.col("host").alias("of"), F.explode(suffixes(F.col("host"))).alias("host")).join(side, "host")
            .groupBy(F.col("of").alias("host"))
            .agg(F.collect_set(F.struct(F.char_length("rule").alias("size"), (F.col("verdict") == "block").alias("block"), "rule", "path")).alias("rules")))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, and both ways between a host and its parent domain."""
    found = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to")
    links = (pages.where("host <> ''").select(F.col("host").alias("src"), found)
             .select("src", F.translate("to", UPPER, LOWER).alias("dst")).where("src <> dst"))
    # A chain of domains: each with its parent, down to two labels.
    chain = hosts.where("host <> ''").select(F.explode(suffixes(F.col("host"))).alias("src")).distinct()
    up = chain.select("src", F.regexp_replace("src", r"^[^.]*\.", "").alias("dst")).where("src <> dst")
    up = up.where(F.size(F.split("dst", r"\.")) >= 2)
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both).groupBy("src", "dst").agg(F.count("*").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING,
              few: int = 100_000) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, trust, distrust): shares of the pages that rules decide. Up to ``few``
    (counted) edges and seeds are one partition, so that their rounds need no shuffle."""
    if tolerance <= 0 or not 0 < damping < 1:
        raise ValueError("tolerance must be positive, damping between 0 and 1")
    kinds = edges.select(F.lit(1).alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit(-1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    out = kinds.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    steps = kinds.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share")).checkpoint()
    start = (seeds.select(F.lit(1).alias("kind"), "host", F.col("trust").alias("rank"))
             .unionByName(seeds.select(F.lit(-1).alias("kind"), "host", F.col("distrust").alias("rank"))).where("rank > 0").checkpoint())
    one = steps.count() <= few and start.count() <= few
    if one:
        steps, start = steps.coalesce(1).checkpoint(), start.coalesce(1).checkpoint()
    ranks, i, reached = start, 0, -1
    while True:
        i += 1
        before = ranks
        moved = (ranks.withColumnRenamed("host", "src").join(steps, ["kind", "src"])
                 .select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")))
        both = moved.unionByName(start.select("kind", "host", (F.col("rank") * (1 - damping)).alias("rank")))
        if one:
            both = both.coalesce(1)
        ranks = both.groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % CHECKPOINT_EVERY == 0:
            ranks = ranks.checkpoint()
            now = ranks.count()
            if now == reached and (damping ** i <= tolerance or _change(before, ranks) <= tolerance):
                break
            reached = now
    total = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    return ranks.groupBy("host").agg(total(1).alias("trust"), total(-1).alias("distrust"))


def _change(before: DataFrame, after: DataFrame) -> float:
    both = before.select("kind", "host", (-F.col("rank")).alias("rank")).unionByName(after).groupBy("kind", "host").agg(F.sum("rank").alias("d"))
    return both.agg(F.sum(F.abs("d"))).first()[0] or 0.0


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          threshold: float = 1.0, broadcast_hosts: int = 100_000, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust. ``rules`` has host, path, verdict and rule (its name).
    Up to ``broadcast_hosts`` (counted) hosts, what is known of them is broadcast, so that pages are not shuffled."""
    ensure_checkpoint_dir(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                        F.col(html).alias("html"))
    thin = rows.drop("html")
    hosts = thin.select("host").distinct().checkpoint()
    of_hosts = F.broadcast if hosts.count() <= broadcast_hosts else (lambda t: t)
    known = of_hosts(host_rules(hosts, rules))
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["size"].alias("size"), r["block"].alias("block"), r["rule"].alias("rule"))))
    ruled = thin.join(known, "host", "left").withColumn("best", best).drop("rules")
    per_host = ruled.groupBy("host").agg(F.sum((~F.col("best.block")).cast("long")).alias("a"), F.sum(F.col("best.block").cast("long")).alias("b"))
    sums = per_host.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    n_ruled = max(1, (sums.a or 0) + (sums.b or 0))
    part = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.lit(float(n_ruled))
    seeds = per_host.select("host", part("a").alias("trust"), part("b").alias("distrust"))
    scores = of_hosts(propagate(host_edges(rows, hosts), seeds, tolerance))
    verdict = F.when(F.col("best.block"), "block").when(F.col("best").isNotNull(), "allow").when(
        F.coalesce("distrust", F.lit(0.0)) > threshold * F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")
