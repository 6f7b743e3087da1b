"""footfall: product analytics over web-event logs, as plain PySpark DataFrames."""

from footfall.config import EngineConfig

__all__ = ["EngineConfig"]
