"""Sources and sinks."""
from .ordering import dense_rank_by, with_arrival_order, with_file_order, with_row_index
from .readers import detect_format, null_tokens, read_csv_checked, read_feedback, require_columns
from .sinks import write_corrections, write_enriched, write_payload, write_sections, write_table

__all__ = ["dense_rank_by", "detect_format", "null_tokens", "read_csv_checked", "read_feedback",
           "require_columns", "with_arrival_order", "with_file_order", "with_row_index", "write_corrections",
           "write_enriched", "write_payload", "write_sections", "write_table"]
