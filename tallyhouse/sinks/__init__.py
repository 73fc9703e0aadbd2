from tallyhouse.sinks.jdbc import overwrite_jdbc, reload_jdbc
from tallyhouse.sinks.tables import (
    create_mart_tables,
    overwrite_catalog_table,
    overwrite_parquet,
    reload_catalog_table,
    sorted_by,
)

__all__ = [
    "create_mart_tables",
    "overwrite_catalog_table",
    "overwrite_jdbc",
    "overwrite_parquet",
    "reload_catalog_table",
    "reload_jdbc",
    "sorted_by",
]
