"""URL filter by a path-template tree, in DataFrame operations only.

Every host has a tree of its path segments, ``DEPTH`` levels deep (the last
level holds what follows).  Segments are generalised into wildcards, first by
form (long hexadecimal runs and digits), then by statistics, level by level
from the root: where a branch has more than ``MAX_CHILDREN`` children, the
children that hold less than ``MIN_SHARE`` of its pages become one wildcard.

Rules label pages.  Sibling templates with labelled pages whose share of
blocked ones does not differ from that of all siblings by more than chance are
merged.  A template is rejected when its purity - blocked pages of its labelled
ones, smoothed towards its host's purity, and that towards ``PRIOR`` - reaches
``REJECT``.  A template without a labelled page is never rejected: labels
elsewhere on the host say nothing about it.  Pages a rule decides keep the
rule's verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: (verdict, host and path prefix)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_CHILDREN = 20
MIN_SHARE = 0.05
DEPTH = 4
SMOOTHING, PRIOR = 10.0, 0.1
Z = 2.0
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty when it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(rules) -> tuple[Column, Column]:
    """Longest rule that fits (ties: first in alphabetical order), and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, pattern in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        host, _, path = pattern.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(
            F.col("path"), F.lit("/" + path))
        rule, verdict = F.when(fits, F.lit(pattern)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def by_form(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[0-9a-fA-F]{16,}", "*"), "[0-9]+", "*")


def _generalise(nodes: DataFrame, parent: list[str], child: str, scratch: Scratch, wildcard: str = "*") -> DataFrame:
    """Column ``child`` with the rare children of crowded branches as a wildcard."""
    kinds = nodes.groupBy(*parent, child).agg(F.sum("n").alias("n"))
    # written, so that AQE can split the join where one host has most of the rows
    parents = scratch.table(kinds.groupBy(*parent).agg(F.count(F.lit(1)).alias("_kinds"), F.sum("n").alias("_all"))
                            .where(F.col("_kinds") > MAX_CHILDREN), f"crowded-{child}")
    rare = scratch.table(kinds.join(parents, parent).where(F.col("n") < F.col("_all") * MIN_SHARE)
                         .select(*parent, child, F.lit(True).alias("_rare")), f"rare-{child}")
    return (nodes.join(rare, [*parent, child], "left")
            .withColumn(f"{child}_g", F.when(F.col("_rare"), F.lit(wildcard)).otherwise(F.col(child))).drop("_rare"))


def children(path: Column) -> list[Column]:
    """The path by form, cut into ``DEPTH`` pieces: each a slash and a segment
    (the last one all that follow), empty where the path has ended."""
    segments = F.slice(F.split(by_form(path), "/", -1), 2, 1 << 30)
    one = [F.when(F.size(segments) >= k, F.concat(F.lit("/"), F.element_at(segments, k))).otherwise(F.lit("")) for k in range(1, DEPTH)]
    rest = F.concat(F.lit("/"), F.array_join(F.slice(segments, DEPTH, 1 << 30), "/"))
    return [*one, F.when(F.size(segments) >= DEPTH, rest).otherwise(F.lit(""))]


LEVELS = [f"c{k}" for k in range(1, DEPTH + 1)]


def rejected_templates(base: DataFrame, scratch: Scratch) -> DataFrame:
    """``base(host, c1.., label)`` -> the distinct ``(host, c1..)`` whose
    template is rejected.  Tables of the way are deleted as soon as the next
    one is written; the one that is returned stays."""
    blocked, labelled = F.count_if(F.col("label") == "block"), F.count("label")
    nodes = scratch.table(base.groupBy("host", *LEVELS).agg(F.count(F.lit(1)).alias("n"), blocked.alias("blocked"), labelled.alias("labelled"))
                          .withColumn("up", F.lit("")).withColumn("parent", F.lit("")), "nodes-0")
    for k, c in enumerate(LEVELS, 1):
        # the parent of a template is the branch its last segment hangs on
        grown = _generalise(nodes, ["host", "up"], c, scratch, wildcard="/*")
        nodes = scratch.table(grown.withColumn("parent", F.when(F.col(f"{c}_g") == "", F.col("parent")).otherwise(F.col("up")))
                              .withColumn("up", F.concat("up", f"{c}_g")).drop(f"{c}_g"), f"nodes-{k}")
        scratch.drop(f"nodes-{k - 1}", f"crowded-{c}", f"rare-{c}")
    sums = [F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")]
    leaves = scratch.table(nodes.where("labelled > 0").groupBy("host", "parent", "up").agg(*sums), "leaves")
    over = [F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled")]
    parents = scratch.table(leaves.groupBy("host", "parent").agg(*over), "parents")
    hosts = scratch.table(leaves.groupBy("host").agg(*over), "hosts")
    pooled = F.col("all_blocked") / F.col("all_labelled")
    spread = Z * F.sqrt(pooled * (1 - pooled) / F.col("labelled")) + 1 / F.col("labelled")
    own = F.abs(F.col("blocked") / F.col("labelled") - pooled) > spread
    branched = leaves.join(parents, ["host", "parent"]).select(
        "host", "parent", "up", F.when(own, F.col("up")).alias("branch"), "blocked", "labelled")
    branched = scratch.table(branched, "branched")
    host_purity = (F.col("all_blocked") + SMOOTHING * PRIOR) / (F.col("all_labelled") + SMOOTHING)
    bad = scratch.table(
        branched.groupBy("host", "parent", "branch").agg(*sums).join(hosts, "host")
        .where((F.col("blocked") + SMOOTHING * host_purity) / (F.col("labelled") + SMOOTHING) >= REJECT)
        .select(F.col("host").alias("_host"), F.col("parent").alias("_parent"), F.col("branch").alias("_branch")), "rejected")
    same = [F.col("host") == F.col("_host"), F.col("parent") == F.col("_parent"), F.col("branch").eqNullSafe(F.col("_branch"))]
    bad = scratch.table(branched.join(bad, same, "left_semi").select("host", "up"), "rejected-templates")
    out = scratch.table(nodes.join(bad, ["host", "up"], "left_semi").select("host", *LEVELS), "rejected-branches")
    scratch.drop(f"nodes-{DEPTH}", "leaves", "parents", "hosts", "branched", "rejected", "rejected-templates")
    return out


def judge(pages: DataFrame, scratch: Scratch, rules=RULES) -> DataFrame:
    """``pages(page_id, url)`` -> ``(page_id, host, path, rule, verdict)``, one
    row per row.  Null URLs have an empty host and path; null or repeated
    page_ids stay; other columns are ignored; an empty table gives an empty one."""
    host, path = split_url(F.col("url"))
    base = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    rule, label = matching_rule(rules)
    base = base.select("page_id", "host", "path", rule.alias("rule"), label.alias("label"),
                       *[c.alias(name) for c, name in zip(children(F.col("path")), LEVELS)])
    bad = rejected_templates(base, scratch).withColumn("_bad", F.lit(True))
    return base.join(bad, ["host", *LEVELS], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("label", F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
