"""Launcher for spark-submit: ``spark-submit scripts/run_job.py --root ...``
(ship the package with ``--py-files`` or install it on the cluster)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barflow.plans.daily_job import main  # noqa: E402

if __name__ == "__main__":
    main()
