from .arrival import drop_late, running_distinct, sliding_count_on_time
from .distinct import (unique_per_window, unique_per_window_approx, unique_per_window_bitmap, visitor_sketches,
                       visitors_from_sketches)
from .patterns import match_sequence, order_timeout, order_timeout_state
from .reconcile import latest_per_key, reconcile, reconcile_pairs
from .rules import consecutive_events, daily_cap
from .topn import top_n_per_window
from .windows import marketing_counts, pane_counts, sliding_count, tumbling_count, windows_from_panes

__all__ = ["drop_late", "running_distinct", "sliding_count_on_time", "unique_per_window", "unique_per_window_approx",
           "unique_per_window_bitmap", "visitor_sketches", "visitors_from_sketches", "match_sequence", "order_timeout",
           "order_timeout_state", "latest_per_key", "reconcile", "reconcile_pairs", "consecutive_events",
           "daily_cap", "top_n_per_window", "marketing_counts", "pane_counts", "sliding_count",
           "tumbling_count", "windows_from_panes"]
