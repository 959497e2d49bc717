"""File sources and sinks (parquet, csv, json, text) and dated output paths."""
from rankwise.sources.formats import (CSV_READ_OPTIONS, CSV_WRITE_OPTIONS,
                                      FORMATS, bucket_name, of_value, read,
                                      resolve_format, split_rejects, write)
from rankwise.sources.paths import dated_output_path, run_date_text
from rankwise.sources.quarantine import Split, read_checked, write_split

__all__ = ["CSV_READ_OPTIONS", "CSV_WRITE_OPTIONS", "FORMATS", "Split", "bucket_name",
           "dated_output_path", "of_value", "read", "read_checked", "resolve_format", "run_date_text",
           "split_rejects", "write", "write_split"]
