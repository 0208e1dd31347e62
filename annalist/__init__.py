"""annalist: trustworthy history from repeated full snapshots, on Spark DataFrames."""

from annalist.spec import EntitySpec

__all__ = ["EntitySpec"]
