from postlake.sources.large_documents import read_large_posts, write_large_document  # noqa: F401
from postlake.sources.lists import load_sources  # noqa: F401
from postlake.sources.readers import (  # noqa: F401
    ingest_search_pages,
    latest_pages,
    load_endpoints,
    posts_of_readable_documents,
    read_ledger,
    read_lines,
    read_posts,
    rejected_documents,
    rejected_pages,
)
from postlake.sources.sinks import write_documents, write_enriched, write_endpoints, write_ledger, write_run  # noqa: F401
