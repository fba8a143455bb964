"""mailweave: mail archives to structured news tables, as Spark jobs.

Two stages, both plain DataFrame jobs that also run under Structured
Streaming:

* ingest  - raw messages -> high-water filter -> insert-if-absent ->
            one distributed parse stage -> native body / address / date
            columns -> ``documents_md`` + per-mailbox state;
* extract - pending documents -> prompt -> pluggable extraction function
            with bounded retries -> JSON repair / validation ->
            quarantine or ``news_items`` rows.

Everything is keyed by ``(account, mailbox, uid)``.
"""

__all__ = ["session", "schemas"]
