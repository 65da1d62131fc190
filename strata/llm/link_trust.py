"""Operator 1, URL filter by link-graph propagation.

Rules judge the urls they fit. For the others the host decides: pages that rules
allow make their hosts trusted seeds, pages that rules block make theirs
distrusted ones, each by its share of such pages. Personalised PageRank carries
trust along links between hosts and distrust against them (who links to a
distrusted host is distrusted). A third rank, which starts from all hosts alike
and goes where distrust goes, says how much of it any host would get. A host is
blocked whose distrust exceeds ``threshold`` of trust and distrust together, and
``floor`` of that third rank: a trace of distrust blocks nobody.

Host edges are the absolute links of the pages' html, counted per pair of hosts,
and, both ways, the step from a host to its parent domain. A step weighs one by the
number of the parent's children, and an edge's share is its weight in the greater of
one and all its host's weights: a site and its one subdomain share their standing, the
many sites of a public domain hardly touch each other.

One join and one aggregation a round over edges that were added up before. The
ranks grow from zero towards their limit, so the change of a round is the change of
their sum; rounds end when it is below ``tolerance``. Only totals reach the driver.
Links to a hub are summed map-side; a hub's own links are split by the skew join.

Defined results
  null urls and urls without ``://``: empty host and path, no rule, allowed; null
  or empty html: no links; hosts that no seed reaches: allowed; equal trust and
  distrust: allowed at a threshold of one half, where a difference below ``MARGIN`` of
  their sum counts as none, so that the order of additions decides nothing; links to the
  own host: ignored; repeated pages count as often as they occur; two rules of equal
  length: the first given; very long html: searched whole, in the scan; empty table: no
  rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut

#: (verdict, host, path): a rule fits its host and all subdomains, under its path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
DAMPING, THRESHOLD, FLOOR = 0.75, 0.5, 0.5
#: Ranks have settled when their sum changes by less; rounds between two looks at it.
TOLERANCE, CUT_EVERY = 1e-4, 6
#: Of trust and distrust together: what differs by less is equal.
MARGIN = 1e-3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"


def url_parts(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, URL, 1), UPPER, LOWER), F.regexp_extract(whole, URL, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits; null if none does."""
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def host_edges(judged: DataFrame, html: DataFrame) -> DataFrame:
    """``(src, dst, n)``: links between hosts, and steps between a host and its parent domain."""
    links = (html.filter("host <> ''").select(F.col("host").alias("src"), F.explode(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
        .withColumn("dst", F.translate("dst", UPPER, LOWER)).filter("src <> dst")
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("n")))
    links = cut(links, "links")
    hosts = (judged.select("host").unionByName(links.select(F.col("dst").alias("host"))).filter("host <> ''").distinct()
             .withColumn("labels", F.split("host", r"\.")))
    # a.b.c.d has the steps a.b.c.d - b.c.d - c.d; top-level domains are no hosts
    steps = hosts.select(F.explode(F.when(F.size("labels") > 2, F.transform(
        F.sequence(F.lit(1), F.size("labels") - 2), lambda i: F.struct(
            F.array_join(F.slice("labels", i, F.size("labels")), ".").alias("a"),
            F.array_join(F.slice("labels", i + 1, F.size("labels")), ".").alias("b"))))).alias("s")).select("s.a", "s.b").distinct()
    children = steps.groupBy("b").agg((F.lit(1.0) / F.count("*")).alias("n"))
    steps = steps.join(children, "b")
    both = steps.select(F.col("a").alias("src"), F.col("b").alias("dst"), "n").unionByName(
        steps.select(F.col("b").alias("src"), F.col("a").alias("dst"), "n"))
    return links.unionByName(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``(host, trust, distrust, base)`` of every host that is a seed or has an edge.

    ``seeds`` has host, good and bad (pages); each kind of seed weighs one in all, and so do
    the hosts that ``base`` starts from.
    """
    edges = cut(edges, "host-edges")
    every = (seeds.select("host", "good", "bad").unionByName(edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0).alias("good"), F.lit(0).alias("bad")))
             .groupBy("host").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    every = cut(every, "hosts")
    count = every.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    rest = 1 - damping
    restart = cut(every.select("host", (rest * F.col("good") / max(count["g"], 1)).cast("double").alias("trust"),
                               (rest * F.col("bad") / max(count["b"], 1)).cast("double").alias("distrust"),
                               F.lit(rest / max(count["n"], 1)).alias("base")), "seeds")
    outs = edges.groupBy("src").agg(F.greatest(F.sum("n"), F.lit(1.0)).alias("total"))
    ins = edges.groupBy("dst").agg(F.greatest(F.sum("n"), F.lit(1.0)).alias("total"))
    # trust goes along an edge by its share of the links out, distrust back by its share of the links in
    moves = (edges.join(outs, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"),
                                            (damping * F.col("n") / F.col("total")).alias("along"), F.lit(0.0).alias("back"))
             .unionByName(edges.join(ins, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"),
                                                        F.lit(0.0).alias("along"), (damping * F.col("n") / F.col("total")).alias("back"))))
    moves = cut(moves.groupBy("host", "to").agg(F.sum("along").alias("along"), F.sum("back").alias("back")), "moves")
    names = ("trust", "distrust", "base")
    state, before, k = restart, None, 0
    while True:
        if k % CUT_EVERY == 0:
            state = cut(state, "ranks") if k else state
            now = state.agg(F.coalesce(F.sum(F.col("trust") + F.col("distrust") + F.col("base")), F.lit(0.0))).first()[0]
            if before is not None and now - before < tolerance:
                return state
            before = now
        moved = moves.join(state, "host").select(F.col("to").alias("host"), (F.col("trust") * F.col("along")).alias("trust"),
                                                 *[(F.col(c) * F.col("back")).alias(c) for c in names[1:]])
        state = moved.unionByName(restart).groupBy("host").agg(*[F.sum(c).alias(c) for c in names])
        k += 1


def blocked(threshold: float = THRESHOLD, floor: float = FLOOR) -> Column:
    """Of a host's ranks: whether distrust prevails, and is more than any host's share."""
    both = F.col("trust") + F.col("distrust")
    return (F.col("distrust") > threshold * both + MARGIN * both) & (F.col("distrust") > (1 + MARGIN) * floor * F.col("base"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", damping: float = DAMPING, threshold: float = THRESHOLD,
          floor: float = FLOOR) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's own verdict, for every page."""
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    judged = cut(parts.drop("html").withColumn("r", rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules))
                 .select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("ruled")), "judged")
    seeds = judged.filter("host <> '' and ruled is not null").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("good"), F.count_if(F.col("ruled") == "block").alias("bad"))
    ranks = propagate(host_edges(judged, parts.select("host", "html")), seeds, damping)
    hosts = ranks.select("host", F.when(blocked(threshold, floor), "block").otherwise("allow").alias("host_verdict"))
    return (judged.join(hosts, "host", "left").withColumn("host_verdict", F.coalesce("host_verdict", F.lit("allow")))
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", "host_verdict").alias("verdict"), "host_verdict"))
