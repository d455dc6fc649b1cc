from .panes import stream_pane_count, stream_top_n
from .stateful import (stream_consecutive_events, stream_daily_cap, stream_match_sequence,
                       stream_order_timeout, stream_reconcile, stream_reconcile_join, prepare)
from .windows import (stream_marketing_counts, stream_sliding_count, stream_tumbling_count,
                      stream_unique_approx, stream_unique_bitmap, stream_unique_per_window, top_n_batches,
                      unique_from_buckets)

__all__ = ["stream_pane_count", "stream_top_n", "stream_consecutive_events", "stream_daily_cap", "stream_match_sequence",
           "stream_order_timeout", "stream_reconcile", "stream_reconcile_join", "prepare", "stream_marketing_counts",
           "stream_sliding_count", "stream_tumbling_count", "stream_unique_approx",
           "stream_unique_bitmap", "stream_unique_per_window", "top_n_batches", "unique_from_buckets"]
