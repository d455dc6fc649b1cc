"""tidemark - event-stream analytics on Spark DataFrames (batch and Structured Streaming)."""

from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .session import checkpoint_location, ensure_checkpoint_dir, get_session

__version__ = "0.1.0"
