"""``python -m trendspark <command> ...`` — same as ``trendspark.plans.cli``."""

import sys

from trendspark.plans.cli import main

sys.exit(main())
