from fieldnorm.functions.encodings import amount_text, date_text, parse_date, timestamp_text, truncate_last_2
from fieldnorm.functions.text import field_text, text_view, trim_strings

__all__ = [
    "amount_text",
    "date_text",
    "field_text",
    "parse_date",
    "text_view",
    "timestamp_text",
    "trim_strings",
    "truncate_last_2",
]
