"""Where the tables are that tests read."""

import os
from pathlib import Path

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
