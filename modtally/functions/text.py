"""Text functions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# The placeholder texts of the dumps and the stored text length.
REMOVED = "[removed]"
DELETED = "[deleted]"
TEXT_LENGTH = 300

# Unicode white space plus the four ASCII separators that Java's class leaves out.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


@pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_html(text: Column) -> Column:
    """Resolve HTML entities. Only texts that hold an ``&`` travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def clean_text(text: Column) -> Column:
    """Unescape, collapse white space, trim, keep the first 300 code points of the result."""
    collapsed = F.regexp_replace(unescape_html(text), WHITESPACE, " ")
    return F.substring(F.trim(collapsed), 1, TEXT_LENGTH)


def strip_backslashes(text: Column) -> Column:
    return F.replace(text, F.lit("\\"), F.lit(""))


def is_placeholder(text: Column, placeholder: str) -> Column:
    """True for the placeholder in plain or markdown-escaped spelling."""
    return strip_backslashes(text) == placeholder
