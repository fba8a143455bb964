"""Document front matter (#32): JSON table form (native) and YAML text form.

Keys in order: uid, message_id, subject, date, from, size always; to, cc,
labels, thread_id, attachments only when non-empty.  The JSON form is a
``named_struct`` with NULL for absent keys and ``to_json`` (which drops NULL
fields); the YAML text (``---``, YAML, ``---``, body) is rendered on export
by a row UDF with ``yaml.safe_dump``, whose worker holds a hundred documents
at a time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nonempty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def front_matter_struct() -> Column:
    return F.struct(
        F.col("uid").alias("uid"),
        F.coalesce("message_id", F.lit("")).alias("message_id"),
        F.coalesce("subject", F.lit("")).alias("subject"),
        F.coalesce("date_iso", F.lit("")).alias("date"),
        F.coalesce("from_addr", F.lit("")).alias("from"),
        F.col("size").alias("size"),
        _nonempty(F.col("to")).alias("to"),
        _nonempty(F.col("cc")).alias("cc"),
        _nonempty(F.col("labels")).alias("labels"),
        F.when(F.coalesce(F.col("thread_id"), F.lit("")) != "", F.col("thread_id")).alias("thread_id"),
        _nonempty(F.col("attachments")).alias("attachments"),
    )


def front_matter_json() -> Column:
    return F.to_json(front_matter_struct(), {"ignoreNullFields": "true"})


def _render(fm_json: str | None, body: str | None) -> str | None:
    import json

    import yaml
    if fm_json is None:
        return None
    fm = json.loads(fm_json)
    return "---\n" + yaml.safe_dump(fm, allow_unicode=True, sort_keys=False, default_flow_style=False) \
        + "---\n" + (body or "")


_render_udf = F.udf(_render, T.StringType(), useArrow=False)


def render_markdown() -> Column:
    """The exported document text: front matter block, then the body."""
    return _render_udf(front_matter_json(), F.col("body"))
