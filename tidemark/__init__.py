"""Commerce and finance analytics on Spark DataFrames."""

from tidemark.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
