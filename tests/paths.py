"""Where the tests find their inputs (its own module: ``conftest`` is no import target,
since every test folder may have one)."""

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
