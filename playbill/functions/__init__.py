"""Column expressions: every function takes and returns a Column, no UDFs."""

from playbill.functions.numbers import (
    bucket_label,
    decade,
    normal_pdf,
    percent_of,
    percent_text,
    rescaled,
)
from playbill.functions.text import (
    contains_ignoring_case,
    first_list_member,
    first_number,
    has_list_member,
    is_missing,
    known,
    safe_key,
    split_trimmed,
    strip_list_marks,
    text_date,
)

__all__ = [
    "bucket_label", "contains_ignoring_case", "decade", "first_list_member", "first_number",
    "has_list_member", "is_missing", "known", "normal_pdf", "percent_of", "percent_text", "rescaled",
    "safe_key", "split_trimmed", "strip_list_marks", "text_date",
]
