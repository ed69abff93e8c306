"""Readers and writers: CSV with row ordinal, Parquet layers, catalog tables."""

from billow.sources.csv import (list_csv_datasets, path_exists, read_csv, read_csv_inferred,
                                read_csv_strings, read_optional, write_csv)
from billow.sources.layers import (Layers, ingest, read_gold_sql, read_layer, save_gold_table,
                                   write_layer)

__all__ = [
    "list_csv_datasets", "path_exists", "read_csv", "read_csv_inferred", "read_csv_strings",
    "read_optional", "write_csv", "Layers", "ingest", "read_gold_sql", "read_layer",
    "save_gold_table", "write_layer",
]
