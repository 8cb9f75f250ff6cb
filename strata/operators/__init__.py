"""Joins, set operations and data-quality checks."""

from strata.operators.joins import (
    collated_join,
    join_size,
    lookup_rejects,
    lookup_replace,
    merge,
    merge_chain,
    natural_join,
    repeated_key,
    snapshot_diff,
)
from strata.operators.quality import Check, parse_check, run_checks
from strata.operators.sets import (
    count_rows,
    distinct_values,
    exists_in,
    first_match,
    is_empty,
    missing_in,
    preview,
    sort_by,
    union_by_name,
)
from strata.operators.snapshots import snapshot_diff_by_digest
