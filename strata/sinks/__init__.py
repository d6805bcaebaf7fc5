"""Writers: Parquet datasets, catalog tables, dynamic partition overwrite, NDJSON publish."""

from strata.sinks.publish import (
    PublishAuditError,
    PublishResult,
    audited_partitions,
    publish_partitioned,
    publish_rows,
    read_published,
    verify_published,
    wire_format,
)
from strata.sinks.tables import (
    create_layers,
    drop_layers,
    insert_overwrite_partitions,
    overwrite_parquet,
    overwrite_partitions,
    save_table,
)

__all__ = [
    "PublishAuditError",
    "PublishResult",
    "audited_partitions",
    "create_layers",
    "drop_layers",
    "insert_overwrite_partitions",
    "overwrite_parquet",
    "overwrite_partitions",
    "publish_partitioned",
    "publish_rows",
    "read_published",
    "save_table",
    "verify_published",
    "wire_format",
]
