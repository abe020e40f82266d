from lakeledger.functions.columns import (  # noqa: F401
    clean_label,
    flag_to_text,
    iso_text,
    normalise_name,
    parse_timestamp_ntz,
    record_key,
    run_stamp,
    run_time,
    try_number,
    try_timestamp_ntz,
    utc,
)
from lakeledger.functions.frames import (  # noqa: F401
    clean_label_column,
    flatten_columns,
    rename_columns,
    trim_text_columns,
    unnest,
)
