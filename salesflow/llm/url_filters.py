"""URL filtering by rules, and by trust and distrust spread over the links between hosts.

A host most of whose pages a rule allows is a trusted seed, one most of whose pages a rule
blocks is a blocked seed. Personalised PageRank carries trust from the trusted seeds along
links; the same with links reversed carries distrust from the blocked seeds to whoever
links to them. A host is blocked if distrust makes up more than ``threshold`` of the two;
a host that neither reaches is allowed. Rules decide before the method does.

Links are counted per pair of hosts before they are shuffled. Every round is one join and
one aggregation over host pairs, written to the checkpoint folder; the driver sees a few
sums of it. Rounds follow from the links: hosts at the end of a long chain are reached too.

A null url or one without ``://`` has an empty host and path, no rule, and is allowed.
Null html has no links. Repeated rows are judged alike. Hosts are compared as written in
the url, A-Z lower-cased. An empty table gives no rows; columns other than the named ones
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.session import cut

DAMPING = 0.85
#: Change of a round, as a share of what the seeds hold, below which the ranks stand.
TOLERANCE = 1e-6
THRESHOLD = 0.5
BROADCAST_HOSTS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute link or one that only leaves out the scheme.
LINK = r"""[Hh][Rr][Ee][Ff]\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""

Rules = dict[str, str]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits, null if none; equally long ones in their given order."""
    ranked = sorted(rules, key=len, reverse=True)
    found = []
    for rule in ranked:
        of, slash, start = rule.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(slash + start)
        found.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: Rules) -> Column:
    return F.coalesce(*[F.when(rule == r, F.lit(v)) for r, v in rules.items()], F.lit(None).cast("string"))


def links(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target, n): links between different hosts, counted."""
    found = df.where(F.col(html).contains("//")).select(
        host_of(F.col(url)).alias("source"),
        F.explode(F.regexp_extract_all(html, F.lit(LINK), 1)).alias("target"),
    )
    return (
        found.select("source", F.translate("target", UPPER, LOWER).alias("target"))
        .where((F.col("source") != "") & (F.col("source") != F.col("target")))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, kind, rank) of hosts that are reached, for kinds ``trust`` and ``distrust``.

    ``edges`` has (source, target, n) rows, ``seeds`` (host, kind, seed). What hosts without
    a way on would pass on returns to the seeds. Rounds go on until one reaches no new host
    and changes the ranks by no more than ``tolerance`` times what the seeds hold.
    """
    both = edges.select("source", "target", "n", F.lit("trust").alias("kind")).union(
        edges.select("target", "source", "n", F.lit("distrust"))
    )
    totals = both.groupBy("source", "kind").agg(F.sum("n").alias("total"))
    shares = cut(
        both.join(totals, ["source", "kind"]).select(
            F.col("source").alias("host"), "kind", "target", (F.col("n") / F.col("total")).alias("share")
        )
    )
    ranks = cut(seeds.select("host", "kind", "seed", F.col("seed").alias("rank")))
    mass = {r[0]: r[1] for r in ranks.groupBy("kind").agg(F.sum("seed")).collect()}
    reached = ranks.count()
    none = F.lit(0.0)
    while True:
        passed = shares.join(ranks, ["host", "kind"]).select(
            F.col("target").alias("host"), "kind", none, (F.col("share") * F.col("rank")), none
        )
        held = ranks.select("host", "kind", "seed", none.alias("inward"), F.col("rank").alias("old"))
        step = cut(
            held.union(passed)
            .groupBy("host", "kind")
            .agg(*[F.sum(c).alias(c) for c in ("seed", "inward", "old")])
        )
        inward = {r[0]: r[1] for r in step.groupBy("kind").agg(F.sum("inward")).collect()}
        back = F.coalesce(
            *[
                F.when(F.col("kind") == k, 1 - damping + damping * (m - inward[k]) / m)
                for k, m in mass.items()
                if m > 0
            ],
            none,
        )
        rank = F.col("seed") * back + damping * F.col("inward")
        after = step.agg(F.count(F.lit(1)).alias("hosts"), F.sum(F.abs(rank - F.col("old"))).alias("moved")).first()
        ranks = step.select("host", "kind", "seed", rank.alias("rank"))
        if after["hosts"] == reached and (after["moved"] or 0.0) <= tolerance * sum(mass.values()):
            return ranks.drop("seed")
        reached = after["hosts"]


def judge(
    df: DataFrame,
    rules: Rules,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every row."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    pages = df.select(F.col(id).alias(id), host.alias("host"), path.alias("path"))
    pages = pages.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    pages = pages.withColumn("ruled", verdict_of(F.col("rule"), rules))
    counts = pages.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ruled") == "allow").alias("allow"),
        F.count_if(F.col("ruled") == "block").alias("block"),
    )
    kinds = F.when(2 * F.col("allow") > F.col("n"), "trust").when(2 * F.col("block") > F.col("n"), "distrust")
    seeds = counts.select("host", kinds.alias("kind"), F.lit(1.0).alias("seed")).where(F.col("kind").isNotNull())
    ranks = propagate(cut(links(df, url, html)), seeds)
    scores = cut(
        ranks.groupBy(F.col("host").alias("of")).agg(
            *[
                F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k)
                for k in ("trust", "distrust")
            ]
        )
    )
    side = F.broadcast(scores) if scores.count() <= BROADCAST_HOSTS else scores
    joined = pages.join(side, F.col("host") == F.col("of"), "left")
    trust, distrust = (F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust"))
    method = F.when(distrust > threshold * (trust + distrust), "block").otherwise("allow")
    return joined.select(
        id,
        "host",
        "path",
        "rule",
        F.coalesce("ruled", method).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
