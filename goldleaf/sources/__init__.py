from goldleaf.sources.tables import (
    append_rows,
    bronze,
    conditional_update,
    layer_counts,
    materialize,
    profile_table,
    profile_tables,
    record_rows,
    replace_table,
    save_overwrite,
    table_sample,
)
from goldleaf.sources.testbed import TABLES, Testbed

__all__ = [
    "TABLES",
    "Testbed",
    "append_rows",
    "bronze",
    "conditional_update",
    "layer_counts",
    "materialize",
    "profile_table",
    "profile_tables",
    "record_rows",
    "replace_table",
    "save_overwrite",
    "table_sample",
]
