"""``python -m lakeops <job> ...``."""

import sys

from lakeops.cli import main

main(sys.argv[1:])
