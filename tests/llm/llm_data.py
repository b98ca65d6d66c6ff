import os
from pathlib import Path

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
LONG = " ".join(f"w{i * 7919 % 5000}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog and then walks home along the river while it rains a little on the hills"
