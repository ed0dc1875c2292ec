"""A PySpark-native engine for document intelligence."""

from .engine import Engine, blank_pages, summary_records
from .functions.structure import abstracts, blocks, chapters, excerpt
from .functions.text import combined_source, detect_language, document_type, route_ocr, route_pages, source_kind, template_of, verify_vlm
from .operators.catalog import bibframe, lilacs, merge_sources
from .operators.gates import result_gates, transcript_gates
from .operators.jobs import counts, job_states, pending, review_state
from .operators.pages import clean_text, split_pages
from .operators.reports import batch_metrics, control_report, judge_cases
from .operators.sections import consolidate, parse_sections, prompt
from .operators.summarize import first_words, summarize
from .operators.transcribe import Tools, transcriber

__all__ = sorted(n for n, v in list(globals().items()) if not n.startswith("_") and callable(v))
