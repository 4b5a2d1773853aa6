"""Column expressions; all of them stay inside the JVM."""

from tidemark.functions.dates import days_between, fiscal_quarter, now_or, strict_date, today_or
from tidemark.functions.keys import surrogate_key
from tidemark.functions.numbers import cents_to_dollars, exact_avg, exact_sum, null_if_zero, safe_divide
from tidemark.functions.text import text_flag, title_case

__all__ = [
    "cents_to_dollars", "days_between", "exact_avg", "exact_sum", "fiscal_quarter", "now_or", "null_if_zero",
    "safe_divide", "strict_date", "surrogate_key", "text_flag", "title_case", "today_or",
]
