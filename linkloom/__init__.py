"""Entity-link analytics on Spark: clean raw record files, check them, report on them."""

from linkloom.tables import Tables

__all__ = ["Tables"]
