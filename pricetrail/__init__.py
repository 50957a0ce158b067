"""Daily item-price analytics on Spark DataFrames.

The data model is small: a daily price fact (one row per item and pull date), an item
dimension, a usage log and a ledger of loaded files.  Everything here is a function from
DataFrames to DataFrames, so that Catalyst sees one declarative plan per question.
"""

from pricetrail.session import configure, local_session, scratch_dir

__all__ = ["configure", "local_session", "scratch_dir"]
