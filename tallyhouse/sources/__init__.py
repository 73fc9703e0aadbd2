from tallyhouse.sources.csv_files import read_csv_staging
from tallyhouse.sources.jdbc import Split, hash_predicates, key_split, read_jdbc
from tallyhouse.sources.parquet import read_layout, read_table

__all__ = [
    "Split",
    "hash_predicates",
    "key_split",
    "read_csv_staging",
    "read_jdbc",
    "read_layout",
    "read_table",
]
