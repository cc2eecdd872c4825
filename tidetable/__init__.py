"""Spark-native analytics for panels of regular time series.

Every operator takes and returns a DataFrame.  A panel has one or more key
columns (``series_key``), one period column (``month``, a DATE at the start of
its period) and measure columns; order always comes from the period column.
"""

from tidetable.session import build_session

__all__ = ["build_session"]
