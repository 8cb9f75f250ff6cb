"""Writers: CSV, Parquet, tables, JDBC and JSON messages."""

from strata.sinks.writers import (
    copy_query_to_parquet,
    load_unless_count,
    save_table,
    text_table_types,
    write_csv,
    write_jdbc,
    write_kafka,
    write_messages,
    write_parquet,
)
