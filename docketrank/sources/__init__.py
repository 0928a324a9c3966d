"""Where rows come from and where results go."""

from docketrank.sources.catalog import (
    describe,
    read_mart,
    read_ranked,
    require_table,
    row_count,
    table_exists,
)
from docketrank.sources.csv import (
    MissingExtract,
    csv_records,
    header_columns,
    line_breaks_by_file,
    parse_csv_records,
    read_text_csv,
    read_text_csv_flagged,
    read_text_csv_tolerant,
    require_rows,
)
from docketrank.sources.footers import footer_figures
from docketrank.sources.sinks import (
    commit_table_version,
    commit_version,
    csv_lines,
    current_version,
    export_csv,
    export_match_report,
    export_ranked_csv,
    export_schema,
    ranked_csv_lines,
    read_parquet_layer,
    replace_parquet,
    replace_table,
    write_table_version,
    write_version,
)

__all__ = [
    "MissingExtract",
    "commit_table_version",
    "commit_version",
    "csv_lines",
    "csv_records",
    "current_version",
    "describe",
    "export_csv",
    "export_match_report",
    "export_ranked_csv",
    "export_schema",
    "footer_figures",
    "header_columns",
    "line_breaks_by_file",
    "parse_csv_records",
    "ranked_csv_lines",
    "read_mart",
    "read_parquet_layer",
    "read_ranked",
    "read_text_csv",
    "read_text_csv_flagged",
    "read_text_csv_tolerant",
    "replace_parquet",
    "replace_table",
    "require_rows",
    "require_table",
    "row_count",
    "table_exists",
    "write_table_version",
    "write_version",
]
