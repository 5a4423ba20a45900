"""Table scans and sinks."""

from riskfold.sources.tables import (  # noqa: F401
    TABLES,
    file_sizes,
    preview,
    read_csv_table,
    read_table,
    table_path,
    write_parquet,
    write_report,
)
