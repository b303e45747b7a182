from .base36 import add_fullname_prefix, id_to_int, int_to_id, normalise_link_id, strip_fullname_prefix
from .names import period_series, periods_between, with_name_parts
from .text import clean_text, is_placeholder, strip_backslashes, unescape_html

__all__ = [
    "add_fullname_prefix",
    "clean_text",
    "id_to_int",
    "int_to_id",
    "is_placeholder",
    "normalise_link_id",
    "period_series",
    "periods_between",
    "strip_backslashes",
    "strip_fullname_prefix",
    "unescape_html",
    "with_name_parts",
]
