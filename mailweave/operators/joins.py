"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a "small" side may have before it is shipped to every executor.  The
# small sides here are narrow key tables (two strings and one or two longs,
# ~50 bytes a row), so 500k rows stay in the tens of MB per executor.  State
# and key-set tables are one row per mailbox (or per key of one round) and are
# usually far below this; beyond it the join stays a shuffle join and AQE
# (skew-join splitting, runtime broadcast conversion) takes over.
# Tunable per session: spark.mailweave.broadcastMaxRows.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_ROWS_CONF = "spark.mailweave.broadcastMaxRows"


def bounded_broadcast(small: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``small`` as a broadcast literal table if it has at most ``max_rows``
    rows, else ``small`` as it is.

    Up to ``max_rows + 1`` rows are computed once and kept; the join reads
    them from memory instead of evaluating ``small`` again.
    """
    if max_rows is None:
        max_rows = int(small.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS)))
    rows = small.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return small
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema))


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left`` rows whose keys are absent from ``right`` (right pruned to keys)."""
    return left.join(right.select(*keys), keys, "left_anti")


GROUP = ["account", "mailbox"]
#: rows of a range table, at most: what is broadcast has this bound whatever the number of mailboxes
SLOTS = 4096


def _slot(df: DataFrame, group: list[str]) -> Column:
    return F.pmod(F.hash(*[df[g] for g in group]), F.lit(SLOTS))


def key_ranges(probe: DataFrame, group: list[str] = GROUP, key: str = "uid") -> DataFrame:
    """[min, max] of ``key`` over the groups of a slot (mailboxes dealt to
    ``SLOTS`` slots by hash): at most ``SLOTS`` rows."""
    return probe.groupBy(_slot(probe, group).alias("_slot")).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))


def within_ranges(existing: DataFrame, probe: DataFrame, group: list[str] = GROUP, key: str = "uid") -> DataFrame:
    """A part of ``existing`` that holds every row whose (group, key) is among
    those of ``probe``: the rows inside the key range of their group's slot.

    A cut, not a join: what passes still has to be matched by key.  The range
    table has ``SLOTS`` rows at most, so it is broadcast as it is, and the cut
    is map-side; no job runs while the plan is built.  A big archive then meets
    only its recent tail in the shuffle that follows.
    """
    r = F.broadcast(key_ranges(probe, group, key))
    cond = [_slot(existing, group) == r["_slot"], existing[key] >= r["_lo"], existing[key] <= r["_hi"]]
    return existing.join(r, cond, "left_semi")


def anti_join_recent(left: DataFrame, right: DataFrame, keys: list[str], probe: DataFrame | None = None,
                     group: list[str] = GROUP, key: str = "uid") -> DataFrame:
    """``anti_join(left, right)`` with ``right`` first cut to the key ranges of
    ``probe`` (default: ``left``'s keys).  Same result, since a row of
    ``right`` outside every range cannot match a row of ``left``."""
    p = (probe if probe is not None else left).select(*keys)
    return anti_join(left, within_ranges(right.select(*keys), p, group, key), keys)


def dedupe_by_key(df: DataFrame, keys: list[str], valid: Column | None = None, order: list[Column] = ()) -> DataFrame:
    """One row per key without shuffling the wide rows: the largest by
    ``order``.  Rows that are not ``valid`` are no rivals; all of them stay.

    Duplicate keys (the same message landed twice) are rare.  Their set is
    found from the key columns alone (a partial count) and, when within the
    broadcast bound, rows with a unique key stay where they are; only the
    duplicated rows are shuffled and reduced to one per key.
    """
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    d = bounded_broadcast(dups)
    unique = df.join(d, keys, "left_anti")
    repeated = df.join(d, keys, "left_semi")
    invalid = None if valid is None else repeated.where(~valid)
    if valid is not None:
        repeated = repeated.where(valid)
    if order:
        repeated = (repeated.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
                    .select("_row.*"))
    else:
        repeated = repeated.dropDuplicates(keys)
    out = unique.unionByName(repeated)
    return out if invalid is None else out.unionByName(invalid)
