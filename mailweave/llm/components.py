"""Connected components of an edge table, as Spark jobs.

Alternating star contraction: every round points each node at the smallest
node its smaller neighbours point at (a join on the parent), then links the
parents of one child with each other (grouped by child).  Each round's edges
are written to the shared folder, so lineage stays short and a lost executor
costs one round.  Nothing is collected but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 100) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)`` for every node that has a link;
    component is the smallest node reachable.  Self links and null ends are
    ignored; an empty table gives an empty table."""
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = scratch.table(e, "edges-0")
    seen = _fingerprint(e)
    for k in range(1, max_rounds + 1):
        if not seen[0]:
            break
        # the smallest parent of every child; written, so that AQE can split the join with the hub nodes
        parent = scratch.table(e.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("up")), f"parents-{k}")
        jumped = e.join(parent, "b", "left").select("a", F.coalesce("up", "b").alias("b")).distinct()
        low = F.min("b").over(Window.partitionBy("a"))
        nxt = (jumped.withColumn("m", low)
               .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                         F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
               .select("p.a", "p.b").where("a <> b").distinct())
        e = scratch.table(nxt, f"edges-{k}")
        now = _fingerprint(e)
        scratch.drop(f"edges-{k - 1}", f"parents-{k}")
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
