"""Change history and data quality on Spark.

Every public function takes and returns DataFrames or Columns; column names come
from a :class:`~tidemark.spec.HistorySpec`, so nothing is tied to one table.
"""

from tidemark.spec import USERS, HistorySpec

__all__ = ["HistorySpec", "USERS"]
