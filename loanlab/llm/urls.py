"""Operator 6: URL filter with a path-template tree for each host (DataFrame functions only).

Rules judge the urls they fit (longest rule).  The urls they judged are the labelled rows of the
method, which judges the rest.  Per host, path segments with digits become wildcards; on each
level a parent's children that are mostly distinct become one wildcard, and children whose
blocked share does not differ from their siblings' (two-proportion z below ``SIMILAR``) are merged.  Going
down the tree the blocked share of a template is smoothed towards its parent's with
``WEIGHT`` pseudo-counts, from the share over all hosts at the top; a template at ``REJECT`` or
more is rejected.

Urls collapse first to (host, template) counts, so a host with a third of all rows is a few rows
from then on; the tree is built one level at a time on these counts, ``DEPTH`` levels deep (the
segments below share one wildcard).  Rejected templates come back to the urls by a join.

Defined results: null url, or none with "://": empty host and path, no rule, allowed; repeated
page_ids are judged row by row; without a labelled row everything else is allowed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import broadcast_if_small, reliable

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DEPTH = 8
WEIGHT = 4.0
SIMILAR = 1.96
REJECT = 0.8
DISTINCT, SPREAD = 16, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def split_url(df: DataFrame, url: str) -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns({"host": F.translate(F.regexp_extract(u, PARTS, 1), UPPER, LOWER), "path": F.regexp_extract(u, PARTS, 2)})


def fitting(rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        host, _, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit("/" + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def template(path: str) -> Column:
    """Segments with digits generalised (file endings stay)."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    general = F.transform(segments, lambda s: F.when(s.rlike(r"^[0-9A-Fa-f-]{8,}$") & s.rlike("[0-9]"), F.lit("<id>")).otherwise(F.regexp_replace(s, "[0-9]+", "<n>")))
    return F.when(F.size(general) > DEPTH, F.concat(F.slice(general, 1, DEPTH), F.array(F.lit("<rest>")))).otherwise(general)


def tree(counts: DataFrame) -> DataFrame:
    """``counts`` (host, segs, n, labelled, blocked) with the smoothed blocked share of each template."""
    every = counts.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.max(F.size("segs")).alias("d")).first()
    prior = (every.b or 0) / every.l if every.l else 0.0
    hosts = reliable(counts.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")))
    share = lambda up: (F.col("b") + WEIGHT * up) / (F.col("l") + WEIGHT)
    t = counts.join(broadcast_if_small(hosts, 200), "host").withColumn("share", share(F.lit(prior))).withColumn("parent", F.lit("")).drop("l", "b")
    for level in range(every.d or 0):
        t = reliable(t.withColumn("seg", F.get("segs", F.lit(level))))
        node = ["host", "parent"]
        kids = reliable(t.where("seg is not null").groupBy(*node, "seg").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]))
        family = reliable(kids.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("n").alias("all_n"), F.sum("labelled").alias("all_l"), F.sum("blocked").alias("all_b")))
        kids = kids.join(broadcast_if_small(family, 300), node)
        ol, ob = F.col("all_l") - F.col("labelled"), F.col("all_b") - F.col("blocked")
        pooled = F.when(F.col("all_l") > 0, F.col("all_b") / F.when(F.col("all_l") > 0, F.col("all_l"))).otherwise(0.0)
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.when(F.col("labelled") > 0, F.col("labelled")) + 1 / F.when(ol > 0, ol)))
        z = F.abs(F.col("blocked") / F.when(F.col("labelled") > 0, F.col("labelled")) - ob / F.when(ol > 0, ol)) / F.when(spread > 0, spread)
        various = (F.col("kinds") >= DISTINCT) & (F.col("kinds") >= SPREAD * F.col("all_n"))
        kids = kids.withColumn("branch", F.when(various | F.col("seg").contains("<"), F.lit("*")).when(F.coalesce(z, F.lit(0.0)) < SIMILAR, F.lit("~")).otherwise(F.concat(F.lit("="), "seg")))
        kids = reliable(kids.select(*node, "seg", "branch", "labelled", "blocked"))
        merged = reliable(kids.groupBy(*node, "branch").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")))
        kids = reliable(kids.select(*node, "seg", "branch").join(broadcast_if_small(merged, 300), [*node, "branch"]))
        t = t.join(broadcast_if_small(kids, 400), [*node, "seg"], "left")
        t = t.withColumns({"share": F.when(F.col("branch").isNull(), F.col("share")).otherwise(share(F.col("share"))),
                           "parent": F.when(F.col("branch").isNull(), F.col("parent")).otherwise(F.concat_ws("/", "parent", "branch"))}).drop("branch", "l", "b", "seg")
    return t


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    rule, verdict = fitting(rules)
    rows = split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "url").select("page_id", "host", "path")
    rows = rows.withColumns({"rule": rule, "said": verdict, "segs": template("path")})
    counts = rows.groupBy("host", "segs").agg(F.count("*").alias("n"), F.count("said").alias("labelled"), F.count(F.when(F.col("said") == "block", 1)).alias("blocked"))
    judged = tree(reliable(counts))
    rejected = reliable(judged.where((F.col("share") >= REJECT) & (F.col("host") != "")).select("host", "segs", F.lit("block").alias("method")))
    rows = rows.join(broadcast_if_small(rejected, 400), ["host", "segs"], "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("said", "method", F.lit("allow")).alias("verdict"))
