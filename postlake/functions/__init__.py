from postlake.functions.expressions import (  # noqa: F401
    classify_failure,
    clamp_page_size,
    cooldown_seconds,
    detail_url,
    normalize_endpoint,
    post_description,
    post_key,
    post_link,
    present,
    words,
)
from postlake.functions.threads import comment_count, comment_nodes, comments_json, readable_threads  # noqa: F401
