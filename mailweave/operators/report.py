"""Run accounting: reconcile listed uids, ingest summary, round log (#15, #19, #41)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYS
from .joins import within_ranges


LISTED, BEFORE, AFTER = 1, 2, 4


def run_reconcile(listed: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Per listed uid: ``skipped`` if its document existed before the run,
    ``new`` if it exists only after, ``missing`` if it exists in neither.
    Exact, by key sets - not by file times.

    One tagged union and one ``bit_or`` per key: a single exchange, combined
    before it; the document keys are first cut, map-side, to the ranges of the
    listed uids.
    """
    keys = listed.select(*KEYS)
    tagged = keys.withColumn("_tag", F.lit(LISTED))
    for side, tag in ((before, BEFORE), (after, AFTER)):
        tagged = tagged.unionByName(within_ranges(side.select(*KEYS), keys).withColumn("_tag", F.lit(tag)))
    seen = tagged.groupBy(*KEYS).agg(F.bit_or("_tag").alias("_tags")).where(F.col("_tags").bitwiseAND(LISTED) != 0)
    status = (F.when(F.col("_tags").bitwiseAND(BEFORE) != 0, F.lit("skipped"))
              .when(F.col("_tags").bitwiseAND(AFTER) != 0, F.lit("new"))
              .otherwise(F.lit("missing")))
    return seen.select(*KEYS, status.alias("status"))


COUNTS = ("new", "skipped", "failed", "processed")


def ingest_summary(reconciled: DataFrame, failures: DataFrame) -> DataFrame:
    """new / skipped / failed / processed per mailbox.

    ``processed`` counts listed uids; ``failed`` counts failure rows of the
    run (invalid records, parse errors).  Counting is a partial aggregate, so
    a huge mailbox costs one partial row per task.
    """
    counts = reconciled.groupBy("account", "mailbox").agg(
        F.count_if(F.col("status") == "new").cast("bigint").alias("new"),
        F.count_if(F.col("status") == "skipped").cast("bigint").alias("skipped"),
        F.count(F.lit(1)).cast("bigint").alias("processed"),
    )
    fails = failures.groupBy("account", "mailbox").agg(F.count(F.lit(1)).cast("bigint").alias("failed"))
    return (counts.join(fails, ["account", "mailbox"], "full")
            .select("account", "mailbox",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS]))


# exit_code: 0 done, 1 ingest failed, 2 extraction failed for some document (or altogether)
ROUND_LOG = ("round bigint, stage string, started_at timestamp, exit_code int, duration_s double, rows bigint, "
             "failed bigint, blocked bigint, error string, new bigint, skipped bigint, processed bigint")
