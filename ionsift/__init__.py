"""Feature filtering, matching and ranking for non-targeted measurement tables on Spark."""

from ionsift.params import Params

__all__ = ["Params"]
