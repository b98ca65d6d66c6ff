import sys

from orbitframe.cli import main

sys.exit(main())
