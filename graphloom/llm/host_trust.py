"""Verdicts on urls from rules and from trust that flows along the links between hosts.

Hosts whose pages are mostly allowed by a rule are trusted seeds, hosts whose pages are mostly blocked by one are
distrusted seeds. Trust is the personalised PageRank from the trusted seeds along links; distrust is the same from the
distrusted seeds against the links, as a host that links to a bad one is suspect. A page that no rule fits is blocked
if its host's distrust exceeds its trust by more than a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import UPPER, sized_broadcast, stored

#: Rules as (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Share of a host's score that goes on along its links in a round, and how much more distrust than trust blocks.
DAMPING, MARGIN = 0.85, 0.0
#: The summed change of the scores below which rounds end.
TOLERANCE = 1e-10
#: What a page does not show, where no link stands: comments, and elements whose content is no markup.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|noscript)\b.*?(?:</\1\s*>|\z)"
#: Links of a page: the values of href, quoted or not; of data-href and the like not.
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rule(rows: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rows`` (host, path) with the longest rule that fits, and its verdict; null where none does."""
    rule: Column = F.lit(None).cast("string")
    told: Column = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):  # the last that fits stays
        host, slash, path = text.partition("/")
        path = slash + path
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
        rule, told = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(told)
    return rows.withColumn("rule", rule).withColumn("told", told)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts, with the share of the source's links that goes there.

    A link without a host of its own stays on the page's host and is no edge. Links are counted before the shuffle, so
    the links of a host that has a third of all pages are few rows.
    """
    seen = F.regexp_replace("html", UNSEEN, " ")
    groups = [F.regexp_extract_all(seen, F.lit(HREF), k) for k in (1, 2, 3)]
    href = F.explode(F.concat(*groups)).alias("href")
    links = pages.select(url_host(F.col("url")).alias("src"), href).where("href rlike '^[ \t\r\n]*([A-Za-z][A-Za-z0-9+.-]*:)?//'")
    whole = F.when(F.col("href").rlike("^[ \t\r\n]*//"), F.concat(F.lit("http:"), F.trim("href"))).otherwise(F.col("href"))
    named = links.select("src", url_host(whole).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return named.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score): the personalised PageRank of ``seeds`` (host, mass) over ``edges`` (src, dst, n).

    Scores start at the seeds' shares; each round gives 1 - damping to the seeds and passes the rest along the links.
    What a host without links holds returns to the seeds. Rounds end when the scores change by less than ``tolerance`` in
    sum and a round has reached no new host; the driver sees these numbers and what was passed. Only hosts that a seed
    reaches have a row. What is sent to a host is summed before the shuffle, so a host that all others link to is one
    row of each task.
    """
    total = seeds.agg(F.sum("mass").alias("all"))
    start = stored(seeds.select("host", (F.col("mass") / total.scalar()).alias("seed")), "seeds")
    out = edges.groupBy("src").agg(F.sum("n").alias("of"))
    shares = edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("of")).alias("w"))
    shares = stored(shares, "shares")
    if shares.isEmpty() or start.isEmpty():
        return start.select("host", F.col("seed").alias("score"))
    had = start.select("host", "seed", F.col("seed").alias("score"))
    while True:
        sent = shares.join(had, shares.src == had.host).groupBy("dst").agg(F.sum(F.col("score") * F.col("w")).alias("sent"))
        come = sent.select(F.col("dst").alias("host"), F.lit(0.0).alias("seed"), F.lit(0.0).alias("was"), "sent", F.lit(0).alias("old"))
        kept = had.select("host", "seed", F.col("score").alias("was"), F.lit(0.0).alias("sent"), F.lit(1).alias("old"))
        summed = [F.sum(c).alias(c) for c in ("seed", "was", "sent", "old")]
        new = stored(kept.union(come).groupBy("host").agg(*summed), "trust_round")
        seen = new.agg(F.sum("sent").alias("passed"), F.count_if(F.col("old") == 0).alias("reached")).first()
        back = 1 - damping + damping * (1 - seen["passed"])
        score = F.col("seed") * F.lit(back) + F.lit(damping) * F.col("sent")
        had = new.select("host", "seed", score.alias("score"))
        if seen["reached"] == 0 and new.agg(F.sum(F.abs(score - F.col("was")))).first()[0] < tolerance:
            return had.select("host", "score")


def host_scores(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Stored host, trust, distrust of every host that a seed reaches."""
    judged = with_rule(pages.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")), rules)
    count = judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("told") == "allow").alias("good"),
        F.count_if(F.col("told") == "block").alias("bad"),
    )
    count = stored(count, "host_counts")
    good = count.where("2 * good > n").select("host", F.col("good").cast("double").alias("mass"))
    bad = count.where("2 * bad > n").select("host", F.col("bad").cast("double").alias("mass"))
    edges = stored(host_edges(pages), "host_edges")
    turned = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, good).select("host", F.col("score").alias("trust"))
    distrust = propagate(turned, bad).select("host", F.col("score").alias("distrust"))
    both = trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
    return stored(both, "host_scores")


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, margin: float = MARGIN) -> DataFrame:
    """Each row of ``pages`` with the verdict on its url.

    Reads page_id, url and html; other columns are ignored. A null url, or one without ``://``, has an empty host and
    path; no rule fits it and it is allowed. A null html has no links. Rows that repeat a page_id or a url are judged
    each for itself and all count. The longest rule that fits decides; of rules of one length the later in the list.
    A host that no seed reaches has no trust and no distrust and is allowed. An empty table gives no rows. Returns
    page_id, host, path, rule, verdict, trust and distrust.
    """
    pages = pages.select("page_id", "url", "html")
    scores = host_scores(pages, rules).withColumnRenamed("host", "of_host")
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    joined = with_rule(rows, rules).join(sized_broadcast(scores), F.col("host") == F.col("of_host"), "left")
    by_graph = F.when(F.coalesce(F.col("distrust") - F.col("trust") > margin, F.lit(False)), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("told", by_graph).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
