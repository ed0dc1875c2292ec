"""Readers and writers."""

from .files import (
    pdf_files,
    pdf_info,
    read_control_set,
    read_ocr_meta,
    read_summaries,
    screen_uploads,
    text_documents,
    write_json_array,
    write_json_file,
    write_ocr_meta,
    write_records,
)

__all__ = ["pdf_files", "pdf_info", "read_control_set", "read_ocr_meta", "read_summaries", "screen_uploads", "text_documents", "write_json_array", "write_json_file", "write_ocr_meta", "write_records"]
