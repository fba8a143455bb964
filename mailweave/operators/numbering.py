"""Skew-safe numbering: ranks within a mailbox, and global positions.

A plain ``row_number() over (partition by account, mailbox order by uid)``
puts a whole mailbox into one task - with one mailbox holding a third of all
messages that is a third of the data in one sort.  Two exact alternatives:

* :func:`rank_in_group` - ranks within a group for a key that is unique in
  its group (uids are).  Keys are cut into fixed-width ranges; a range can
  hold at most ``2**bits`` rows, so every window partition is bounded.  A
  tiny per-range count table gives each range its offset.
* :func:`global_positions` - a total order over the whole table:
  ``repartitionByRange`` + sort within partitions + per-partition counts.
  The offset table has one row per partition (a proven broadcast bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 17      # at most 131,072 rows per (group, range) window partition


def rank_in_group(df: DataFrame, group_cols: list[str], key: str, bits: int = RANGE_BITS,
                  descending: bool = False, rank_col: str = "rank", newest: int | None = None) -> DataFrame:
    """Exact 1-based rank of ``key`` within ``group_cols`` (key unique per group).

    With ``newest`` only the ranges that can hold the last ``newest`` rows of a
    group are ranked: those with fewer rows than that in the ranges after them.
    At most ``newest`` rows and one range per group enter the windows then.

    Shuffles: one partial-aggregated count, one small window over the count
    table, one join + window that share the same hash partitioning
    ``(group, range)`` - a hot group is spread over many ranges.
    """
    rng = F.shiftright(F.col(key), bits)
    counts = df.groupBy(*group_cols, rng.alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    g = Window.partitionBy(*group_cols)
    offsets = counts.select(
        *group_cols, "_r",
        F.coalesce(F.sum("_n").over(g.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"),
        F.sum("_n").over(g).alias("_total"), "_n",
    )
    if newest is not None:
        offsets = offsets.where(F.col("_total") - F.col("_off") - F.col("_n") < newest)
    offsets = offsets.drop("_n")
    j = df.withColumn("_r", rng).join(offsets, [*group_cols, "_r"])
    local = F.row_number().over(Window.partitionBy(*group_cols, "_r").orderBy(F.col(key)))
    asc = F.col("_off") + local
    r = (F.col("_total") - asc + 1) if descending else asc
    return j.withColumn(rank_col, r.cast("bigint")).drop("_r", "_off", "_total")


def newest_n(df: DataFrame, n: int | None, group_cols: list[str] | None = None, key: str = "uid") -> DataFrame:
    """Keep the last ``n`` rows in ascending ``key`` order (per group when
    ``group_cols`` is given); ``n`` NULL or <= 0 keeps everything."""
    if n is None or n <= 0:
        return df
    if not group_cols:
        # global top-n: TakeOrderedAndProject keeps n rows per task, then n
        return df.orderBy(F.col(key).desc()).limit(n)
    return rank_in_group(df, group_cols, key, descending=True, rank_col="_rk", newest=n).where(F.col("_rk") <= n).drop("_rk")


def batch_assign(df: DataFrame, size: int, group_cols: list[str], key: str = "uid") -> DataFrame:
    """Consecutive chunks of ``size`` in ``key`` order within each group."""
    r = rank_in_group(df, group_cols, key, rank_col="_rk")
    return r.withColumn("batch_no", F.floor((F.col("_rk") - 1) / F.lit(size)).cast("bigint")).drop("_rk")


def global_positions(df: DataFrame, order: list[Column], num_partitions: int | None = None,
                     pos_col: str = "pos") -> DataFrame:
    """1-based position of every row in the total order ``order``.

    The range-partitioned, sorted table is checkpointed (reliably, to the
    shared checkpoint folder) together with each row's partition id and
    index, so the per-partition counts and the positions are computed from
    the same materialised layout even if executors are lost.
    """
    spark = df.sparkSession
    from ..session import shared_dir
    shared_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.select("*", *[o.alias(f"_k{i}") for i, o in enumerate(order)])
    knames = [f"_k{i}" for i in range(len(order))]
    sorted_ = keyed.repartitionByRange(n, *knames).sortWithinPartitions(*knames)
    tagged = sorted_.select(
        "*", F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("_idx"),
    ).checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offs), "_pid")          # one row per partition
    return out.withColumn(pos_col, (F.col("_off") + F.col("_idx") + 1).cast("bigint")).drop(
        "_pid", "_idx", "_off", *knames)
