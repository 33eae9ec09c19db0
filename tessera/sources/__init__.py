"""Sources: driver parquet tables, headed CSV, and reference-shaped stand-ins."""

from tessera.sources.csv import load_csv, write_csv
from tessera.sources.tables import TABLES, load, table_path

__all__ = ["TABLES", "load", "table_path", "load_csv", "write_csv"]
