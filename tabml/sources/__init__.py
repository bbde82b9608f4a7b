"""Sources and sinks: delimited text, Parquet tables, saved pipelines."""

from tabml.sources.delimited import apply_schema, clean_headers, read_delimited, write_delimited
from tabml.sources.models import load_pipeline, load_spec, save_pipeline, save_spec, spec_params
from tabml.sources.tables import read_table

__all__ = [
    "apply_schema",
    "clean_headers",
    "load_pipeline",
    "load_spec",
    "read_delimited",
    "read_table",
    "save_pipeline",
    "save_spec",
    "spec_params",
    "write_delimited",
]
