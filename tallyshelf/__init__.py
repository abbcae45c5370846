"""Tallyshelf: cleaning, reshaping and reporting for product-catalog data on Spark.

Everything is a ``DataFrame -> DataFrame`` function with column names as
parameters, so it composes through ``df.transform`` and leaves the physical
plan to Catalyst and AQE.
"""

from tallyshelf.session import get_spark
from tallyshelf.spec import CatalogSpec

__all__ = ["CatalogSpec", "get_spark"]
