"""Sources and sinks."""

from quarry.sources.files import (  # noqa: F401
    load_table,
    nan_to_null,
    parse_decimal_comma,
    read_csv,
    read_stage,
    stage,
    write_csv,
)
from quarry.sources.jdbc import append_to, read_jdbc, replace_table  # noqa: F401
from quarry.sources.etl import report_table, run_etl, stamp_batch  # noqa: F401
