"""Emporio: a Spark-native retail warehouse.

Source tables land in date-partitioned Parquet, are typed and deduplicated,
conformed, shaped into a star schema and read through a measure layer.  Every
step is a function from DataFrames to a DataFrame, so Catalyst sees the whole
plan and nothing is hidden in user-defined functions.
"""

from emporio.config import WarehouseConfig
from emporio.registry import TABLES, TABLES_BY_NAME, TableEntry

__all__ = ["TABLES", "TABLES_BY_NAME", "TableEntry", "WarehouseConfig"]
