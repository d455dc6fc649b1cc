"""Helpers of these tests."""

import os

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")


def plain(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
