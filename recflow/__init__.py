"""Recommendation analytics on Spark DataFrames.

Every public operator takes DataFrames and returns a DataFrame without
triggering an action; the caller decides when to write, cache or collect.
"""

from recflow.params import Params

__all__ = ["Params"]
