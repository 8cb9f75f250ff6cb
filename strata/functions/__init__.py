"""Column expressions and column-name rules."""

from strata.functions.keys import (
    BLANK_SENTINEL,
    KEY_COLUMN,
    KEY_PATTERN,
    KEY_PATTERN_UNESCAPED_DOTS,
    NULL_KEY_POLICIES,
    blank_to_sentinel,
    case_insensitive,
    clean_key,
    with_clean_key,
)
from strata.functions.messages import nan_text_to_null, nan_to_null, parse_messages, to_messages
from strata.functions.names import (
    ascii_name,
    cast_all_to_string,
    drop_columns,
    drop_suffixed,
    fill_blank,
    lower_name,
    prefix_columns,
    rename_all,
    rename_present,
    strip_suffix,
    unicode_name,
)
