"""Training-data operators: ten per-corpus jobs and the helpers they share.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the subpackage is present.
"""
