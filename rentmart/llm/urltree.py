"""URL filter by a tree of path templates, in DataFrame operations alone.

Each path is generalised segment by segment, from the root of its host down. A segment with a digit, or one that holds
less than one in ``RARE`` pages of its parent branch, becomes the wildcard ``*``; so a parent has at most ``RARE``
other branches. Pages that a rule decides are the labels. Siblings under one parent are put in order of their blocked share,
smoothed by the parent's, those without a label after the others; neighbours whose shares do not differ (a two-sample z
below ``LIKE``) become one branch, named by all their segments, and the next level sees the merged tree. Levels go on as long as some parent has two ways
below it. A template's purity is its blocked share, smoothed by that of its first segment over all hosts and by
that of all pages; a page that no rule decides is blocked when its template's purity is ``reject`` or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick, union_all

#: (verdict, host, path) of the production rules (fixed values)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
RARE, LIKE, WEIGHT = 50, 2.0, 10.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the rule that fits and is longest (host, then path); null without one."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _named(segments: Column) -> Column:
    """One branch's name from the segments it merges: itself, or all of them between braces."""
    inside = F.concat(F.lit("{"), F.array_join(segments, "|"), F.lit("}"))
    return F.when(F.size(segments) > 1, inside).otherwise(F.element_at(segments, 1))


def merged_siblings(here: DataFrame, base: Column) -> DataFrame:
    """host, parent, branch, name: what each branch of each parent is called after wildcards and merging.

    ``here``: host, parent, branch, n, seen, bad. All windows run over the siblings of one parent that are not rare.
    """
    counts = here.groupBy("host", "parent", "branch").agg(*[F.sum(c).alias(c) for c in ("n", "seen", "bad")])
    total = counts.groupBy("host", "parent").agg(F.sum("n").alias("p_n"), F.sum("seen").alias("p_seen"), F.sum("bad").alias("p_bad"))
    counts = counts.join(total, ["host", "parent"])
    rare = (F.col("n") * RARE < F.col("p_n")) | (F.col("branch") == "*")
    counts = counts.withColumn("kind", F.when(rare, "*").otherwise(F.col("branch")))
    kinds = counts.groupBy("host", "parent", "kind", "p_seen", "p_bad").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    expected = (F.col("p_bad") + WEIGHT * base) / (F.col("p_seen") + WEIGHT)
    weight = F.col("seen") + WEIGHT
    kinds = kinds.withColumns({"share": (F.col("bad") + WEIGHT * expected) / weight, "weight": weight})
    bare = F.col("seen") == 0
    order = Window.partitionBy("host", "parent").orderBy(bare, "share", "kind")
    before, its = F.lag("share").over(order), F.lag("weight").over(order)
    both = (F.col("share") * F.col("weight") + before * its) / (F.col("weight") + its)
    noise = F.sqrt((both * (1 - both) + 0.01) * (1 / F.col("weight") + 1 / its))
    apart = F.coalesce(((F.col("share") - before >= LIKE * noise) | (bare != (F.lag("seen").over(order) == 0))).cast("int"), F.lit(0))
    kinds = kinds.withColumn("apart", apart).withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    names = kinds.groupBy("host", "parent", "run").agg(F.sort_array(F.collect_list("kind")).alias("kinds"))
    names = names.select("host", "parent", F.explode("kinds").alias("kind"), _named(F.col("kinds")).alias("name"))
    return counts.join(names, ["host", "parent", "kind"]).select("host", "parent", "branch", "name")


def judge(pages: DataFrame, rules=RULES, reject: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity, for each row of ``pages``.

    ``pages``: page_id, url; other columns are ignored. A rule fits a path that starts with the
    rule's, so an empty path (a host alone) fits none of them. A null url, or one without ``://``, has an empty host and
    path and belongs to the template of the root. Rows that share a page_id are judged each. An empty table gives no row.
    """
    p = pick(pages, "page_id", "url").select("page_id", *[c.alias(n) for n, c in zip(("host", "path"), host_path(), strict=True)])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    marked = F.transform(segments, lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))
    p = cut_lineage(p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), marked.alias("way")))
    # distinct ways per host, pre-aggregated: the tree is as large as the site map, not as the table
    ways = p.groupBy("host", "way").agg(F.count("*").alias("n"), F.count("ruled").alias("seen"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad"))
    ways = cut_lineage(ways.withColumn("template", F.col("way")))
    seen, bad = ways.agg(F.sum("seen"), F.sum("bad")).first()
    base = F.lit(bad / seen if seen else 0.0)
    done, level = [], 1
    while True:
        # parents with one way below have nothing to merge, at this level or any further one
        parent = F.slice("template", 1, level - 1)
        ways = ways.withColumn("parent", parent).filter(F.size("template") >= level)
        several = ways.groupBy("host", "parent").agg(F.count("*").alias("ways")).filter("ways > 1").select("host", "parent")
        here = cut_lineage(ways.join(several, ["host", "parent"]).withColumn("branch", F.element_at("template", level)))
        if here.isEmpty():
            break
        names = merged_siblings(here, base)
        rest = F.slice("template", level + 1, F.greatest(F.size("template") - level, F.lit(0)))
        ways = here.join(names, ["host", "parent", "branch"]).withColumn("template", F.concat("parent", F.array("name"), rest))
        ways = cut_lineage(ways.select("host", "way", "n", "seen", "bad", "template"))
        done.append(ways.select("host", "way", "template", F.lit(level).alias("level")))
        level += 1
    every = p.select("host", "way").distinct().select("host", "way", F.col("way").alias("template"), F.lit(0).alias("level"))
    last = union_all([every, *done]).groupBy("host", "way").agg(F.max_by("template", "level").alias("template"))
    p = p.join(last, ["host", "way"])
    first = F.coalesce(F.get("template", F.lit(0)), F.lit(""))
    own = p.groupBy("host", "template").agg(F.count("ruled").alias("seen"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad")).withColumn("first", first)
    own = cut_lineage(own)
    over = own.groupBy("first").agg(F.sum("seen").alias("f_seen"), F.sum("bad").alias("f_bad"))
    shared = (F.col("f_bad") + WEIGHT * base) / (F.col("f_seen") + WEIGHT)
    purity = (F.col("bad") + WEIGHT * shared) / (F.col("seen") + WEIGHT)
    out = p.join(own.join(over, "first").select("host", "template", purity.alias("purity")), ["host", "template"])
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    template = F.concat(F.lit("/"), F.array_join("template", "/"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), template.alias("template"), "purity")
