"""Table schemas (DDL strings), one per table of the pipeline."""

ADDRESS = "struct<name:string,addr:string>"
PART = "struct<part_no:int,ctype:string,disposition:string,filename:string,payload:string>"

KEYS = ["account", "mailbox", "uid"]

RAW_MESSAGES = (
    "account string, mailbox string, uid bigint, raw binary, size bigint, "
    "labels array<string>, thread_id string"
)

# Output of the one Python stage (parse_messages); everything after it is
# native expressions over these columns.
PARSED = (
    "account string, mailbox string, uid bigint, size bigint, "
    "labels array<string>, thread_id string, message_id string, "
    "subject string, date_fields array<int>, "
    f"from_list array<{ADDRESS}>, to_list array<{ADDRESS}>, cc_list array<{ADDRESS}>, "
    f"parts array<{PART}>, parse_error string"
)

DOCUMENTS_MD = (
    "account string, mailbox string, uid bigint, message_id string, subject string, "
    "date_iso string, date_ts timestamp, from_addr string, to array<string>, "
    "cc array<string>, size bigint, labels array<string>, thread_id string, "
    "body string, attachments array<string>"
)

STATE = "account string, mailbox string, last_uid bigint"
ATTEMPTS = "account string, mailbox string, uid bigint, attempt_no int, response string, error string"
RESULTS = "account string, mailbox string, uid bigint, response string, repaired boolean, valid_json boolean"
NEWS_ITEM = "struct<title:string,url:string,summary:string,date:string,sender:string>"
NEWS_ITEMS = (
    "account string, mailbox string, uid bigint, pos int, title string, url string, "
    "summary string, date string, sender string"
)
QUARANTINE = "account string, mailbox string, uid bigint, error string"
FAILURES = "account string, mailbox string, uid bigint, stage string, error string"
LEDGER = "file string, attempts int, error string"
