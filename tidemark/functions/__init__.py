from .hashing import hash61
from .text import cap_warning, format_topn_report, login_alert
from .time import (epoch_micros, event_time, floor_to, micros_of, parse_duration, render_epoch_ms,
                   render_ts)

__all__ = ["hash61", "cap_warning", "format_topn_report", "login_alert", "epoch_micros",
           "event_time", "floor_to", "micros_of", "parse_duration", "render_epoch_ms", "render_ts"]
