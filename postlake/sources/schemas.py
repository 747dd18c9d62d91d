"""Schemas of the captured inputs and of the documents written and read back."""

POST = (
    "id string, name string, title string, author string, subreddit string, permalink string, "
    "link string, description string, created_utc double, score bigint, num_comments bigint"
)

# Read back from documents: ``body`` and ``comments`` are there only on enriched posts.
DOCUMENT_POST = POST + ", body string, comments variant"

# Fits ``{"metadata": …, "posts": […]}`` and a bare ``[…]`` of posts alike.
DOCUMENT = f"metadata string, enrichment_summary string, posts array<struct<{DOCUMENT_POST}>>, {DOCUMENT_POST}"

RAW_POST = (
    "id string, name string, title string, author string, subreddit string, permalink string, "
    "url string, selftext string, created_utc double, score bigint, num_comments bigint"
)

SEARCH_PAGE = f"struct<data: struct<after: string, children: array<struct<data: struct<{RAW_POST}>>>>>"

LEDGER_MAP = "map<string, struct<last_ok: bigint, ok_streak: bigint, fail_streak: bigint>>"
