from postlake.streaming.dedup import stream_dedup, stream_dedup_posts  # noqa: F401
from postlake.streaming.enrichment import enriched_so_far, stream_enrich, stream_enrich_late  # noqa: F401
from postlake.streaming.health import (  # noqa: F401
    history_so_far,
    stream_endpoint_history,
    stream_health_ledger,
    stream_pool_state,
    stream_state_changes,
)
from postlake.streaming.ledger import kept_history, stream_kept_ledger, stream_kept_states, update_ledger  # noqa: F401
from postlake.streaming.running import drain, drain_to_parquet  # noqa: F401
