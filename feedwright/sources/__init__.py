from feedwright.sources.tables import DRIVER_TABLES, read_table  # noqa: F401
from feedwright.sources.scans import (  # noqa: F401
    scan_dated_path, scan_delta, scan_raw, scan_refined, scan_sql, dated_path,
)
