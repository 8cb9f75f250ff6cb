"""Readers: delimited file families, Parquet, catalog and JDBC tables."""

from strata.sources.catalog import list_tables, parquet_to_table, read_jdbc
from strata.sources.files import (
    DEFAULT_FAMILY,
    FAMILIES,
    LATIN_1,
    Family,
    detect_encoding,
    family_for,
    list_files,
    read_csv_skip_long_lines,
    read_family,
    touch,
)
from strata.sources.parquet import read_parquet
