from .ordered import balanced_buckets, balanced_neighbors, floor_div, time_bucket, with_neighbors

__all__ = ["balanced_buckets", "balanced_neighbors", "floor_div", "time_bucket", "with_neighbors"]
