"""barflow: a Spark-native engine for daily price histories of stocks and ETFs.

Every operator is ``DataFrame -> DataFrame`` (chainable with ``.transform``),
declared with the DataFrame API so Catalyst can prune, push down and plan.
Nothing runs at import time and no global session is created.
"""

from barflow.config import JobConfig

__all__ = ["JobConfig"]
__version__ = "0.1.0"
