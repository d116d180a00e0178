from tidemark.functions.calendar import calendar_columns, date_key
from tidemark.functions.clean import as_date, as_number, as_timestamp, blank_to_null, trimmed
from tidemark.functions.keys import surrogate_key, version_key

__all__ = [
    "as_date", "as_number", "as_timestamp", "blank_to_null", "calendar_columns", "date_key",
    "surrogate_key", "trimmed", "version_key",
]
