"""URL filter: rules by host and path, and link-graph propagation for addresses no rule fits.

1. Rules. A rule (host, path) fits its host and all subdomains where the address's path begins
   with the rule's; the longest text host + path wins, then the longer host.
   Candidates are found by equality alone: a host's parent domains that rules name, then the
   prefixes of the path whose lengths occur among that domain's rules.
2. Host edges. A page's links to other hosts count once for each page and host. Beside them, hosts
   stand in an edge with the domain above them, both ways, up to two labels, of weight ``kin``
   where all links of a host weigh 1. A table whose pages link within their own host alone still
   has these; addresses of numbers have none.
3. Propagation. A host's share of pages that an allow rule fits is its trust seed, the share under
   block rules its distrust seed. Trust flows along links from the page's host to the one linked
   to; distrust flows back, from a host to those that link to it. Both are personalised PageRank,
   x = (1 - damping) * seed + damping * (flow of x), as two kinds of rows in one table, so one
   join and one sum a round serve both. What a host without edges would pass on is lost, which
   scales a kind's scores alike. As many rounds are made as leave ``tolerance`` of the seeds on
   their way; some at a time are one Spark job, written to the shared folder.
4. Verdict of an address without a rule: block where distrust makes up more than ``threshold`` of
   its host's trust and distrust, else allow, also where neither reached the host.

Sums are combined map-side, so a host with a third of all pages or links reaches the shuffle as
one row a task; rows are joined to a host's by Spark's joins alone, which split a skewed host.

Defined results: every row of ``pages`` gives one, repeated and null ones too. A null address, or
one without "://", has an empty host and path, is fitted by no rule and is allowed. Null html has
no links. Without rules, or with an empty table, nothing propagates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals.plans.shared import settle

RULES_DDL = "host string, path string, verdict string"
DAMPING = 0.85
TOLERANCE = 1e-3
#: Weight of the edges between a host and the domain above it, beside a weight of 1 for its links.
KIN = 0.25
THRESHOLD = 0.5
#: Fixed value: the greatest length of a domain name. Longer hosts have no domain above them.
HOST_LENGTH = 253
#: Rounds that are planned as one job.
ROUNDS_AT_ONCE = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The address of a link to another host: of the kind scheme://host or //host.
LINK = r"""(?i)<a\s[^<>]*?\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]{0,20}:)?//([^/?#"'<>\s]+)"""


def address_host(url: Column) -> Column:
    host = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def address_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    """What follows the first "://"; null without one."""
    at = F.position(F.lit("://"), url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def domains(host: Column, most: int) -> Column:
    """The domains above a host, itself among them, of ``most`` labels at most; longest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.greatest(n - (most - 1), F.lit(1)), n),
        lambda i: F.array_join(F.slice(labels, i, n), "."),
    )


def rule_of(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) of the distinct ``addresses`` that a rule fits."""
    rules = settle(
        rules.filter("host != '' AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict")),
        "rules",
    )
    # the labels of the longest rule: no domain of more can be one's
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    lengths = rules.groupBy(F.col("host").alias("domain")).agg(
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths")
    )
    known = addresses.filter("host != ''")
    hosts = known.select("host").distinct()
    ruled = hosts.select("host", F.explode(domains(F.col("host"), most)).alias("domain")).join(lengths, "domain")
    ruled = settle(ruled, "ruled_hosts")
    tried = known.join(ruled, "host").select(
        "host",
        "path",
        "domain",
        F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"),
    )
    tried = tried.withColumn("prefix", F.substring(F.col("path"), F.lit(1), F.col("n")))
    named = rules.select(F.col("host").alias("domain"), F.col("path").alias("prefix"), "verdict")
    text = F.concat("domain", "prefix")
    order = F.struct(
        F.length(text).alias("n"), F.length("domain").alias("d"), text.alias("rule"), F.col("verdict").alias("v")
    )
    # two rules of one length on one address differ in their hosts' lengths
    best = tried.join(named, ["domain", "prefix"]).groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.v").alias("rule_verdict"))


def host_edges(pages: DataFrame, hosts: DataFrame, kin: float = KIN) -> DataFrame:
    """(from, to, weight) with weights of one host summing to 1: links of ``pages`` (host, html)
    between different hosts, and edges of ``hosts`` with the domains above them."""
    links = pages.filter("host != ''").select("host", F.explode(_targets("html")).alias("to")).filter("to != host")
    linked = links.groupBy(F.col("host").alias("from"), "to").agg(F.count(F.lit(1)).alias("n"))
    total = linked.groupBy("from").agg(F.sum("n").alias("all"))
    linked = linked.join(total, "from").select("from", "to", (F.col("n") / F.col("all")).alias("w"))
    ends = hosts.select("host").unionByName(linked.select(F.col("to").alias("host")))
    named = (F.length("host") <= HOST_LENGTH) & ~F.col("host").rlike(r"(^|\.)[0-9]+(:[0-9]+)?$")
    above = F.filter(domains(F.col("host"), HOST_LENGTH), lambda d: F.instr(d, ".") > 0)
    up = ends.filter(named & (F.col("host") != "")).select(above.alias("up"))
    steps = F.zip_with("up", F.slice("up", F.lit(2), F.size("up")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    pairs = up.filter(F.size("up") > 1).select(F.inline(steps)).filter("b IS NOT NULL").distinct()
    both = pairs.select(F.col("a").alias("from"), F.col("b").alias("to")).unionByName(
        pairs.select(F.col("b").alias("from"), F.col("a").alias("to"))
    )
    degree = both.groupBy("from").agg(F.count(F.lit(1)).alias("all"))
    near = both.join(degree, "from").select("from", "to", (F.lit(kin) / F.col("all")).alias("w"))
    edges = linked.unionByName(near.filter("w > 0")).groupBy("from", "to").agg(F.sum("w").alias("w"))
    whole = edges.groupBy("from").agg(F.sum("w").alias("all"))
    return edges.join(whole, "from").select("from", "to", (F.col("w") / F.col("all")).alias("weight"))


def _targets(html: str) -> Column:
    found = F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
    return F.array_distinct(F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER)))


def rounds_for(damping: float, tolerance: float) -> int:
    """After n rounds damping ** n of the seeds' sum is still on its way."""
    return math.ceil(math.log(tolerance) / math.log(damping))


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(host, kind, score) from ``seeds`` (host, kind, seed): kind "trust" flows along ``edges``,
    "distrust" against them, each way in shares that sum to 1."""
    into = edges.groupBy("to").agg(F.sum("weight").alias("all"))
    flows = edges.select("from", "to", F.lit("trust").alias("kind"), F.col("weight").alias("share"))
    against = edges.join(into, "to").select(
        F.col("to").alias("from"),
        F.col("from").alias("to"),
        F.lit("distrust").alias("kind"),
        (F.col("weight") / F.col("all")).alias("share"),
    )
    flows = settle(flows.unionByName(against), "flows")
    seeds = settle(seeds.filter("seed > 0"), "seeds")
    start = seeds.select("host", "kind", (F.col("seed") * (1 - damping)).alias("score"))
    rounds = rounds_for(damping, tolerance)
    scores, done = start, 0
    while done < rounds:
        for _ in range(min(ROUNDS_AT_ONCE, rounds - done)):
            passed = flows.join(scores.withColumnRenamed("host", "from"), ["from", "kind"]).select(
                F.col("to").alias("host"), "kind", (F.col("share") * F.col("score") * damping).alias("score")
            )
            scores = passed.unionByName(start).groupBy("host", "kind").agg(F.sum("score").alias("score"))
            done += 1
        scores = settle(scores, "scores")
    return scores


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    html: str = "html",
    kin: float = KIN,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``pages`` without their html, with host, path, rule, verdict and the host's
    trust and distrust. Columns of pages that have one of these names are replaced."""
    made = ("host", "path", "rule", "verdict", "trust", "distrust")
    others = [c for c in pages.columns if c != html and c not in made]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    given = pages.select(
        row,
        address_host(F.col(f"`{url}`")).alias("host"),
        address_path(F.col(f"`{url}`")).alias("path"),
        F.col(f"`{html}`").alias("html"),
    )
    counted = settle(given.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "addresses")
    found = settle(rule_of(counted, rules), "matched")
    verdicts = counted.join(found, ["host", "path"], "left").groupBy("host").agg(
        F.sum("n").alias("all"),
        *[F.sum(F.when(F.col("rule_verdict") == v, F.col("n"))).alias(v) for v in ("allow", "block")],
    )
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), (F.col(v) / F.col("all")).alias("seed"))
            for kind, v in (("trust", "allow"), ("distrust", "block"))
        ]
    )
    verdicts = settle(verdicts, "host_verdicts")
    seeds = verdicts.select("host", F.inline(kinds))
    edges = settle(host_edges(given.select("host", "html"), verdicts.select("host"), kin), "host_edges")
    scores = propagate(edges, seeds, damping, tolerance)
    sides = scores.groupBy("host").agg(
        *[
            F.sum(F.when(F.col("kind") == kind, F.col("score"))).alias(kind)
            for kind in ("trust", "distrust")
        ]
    )
    sides = verdicts.select("host").join(sides, "host").select(
        "host", *[F.round(F.coalesce(k, F.lit(0.0)), 9).alias(k) for k in ("trust", "distrust")]
    )
    sides = settle(sides, "host_scores")
    judged = given.drop("html").join(found, ["host", "path"], "left").join(sides, "host", "left")
    trust, distrust = (F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust"))
    # rounded, so that a tie does not hang on the order of sums
    doubtful = F.round(distrust - threshold * (trust + distrust), 9) > 0
    verdict = F.coalesce("rule_verdict", F.when(doubtful, "block").otherwise("allow"))
    return judged.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        "host",
        "path",
        "rule",
        verdict.alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )


#: The rules of the registered query.
QUERY_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUERY_RULES, RULES_DDL)
