"""Record cleaning: string normalisation and text truncation.

Seven required string columns and two optional ones are cleaned by JVM
expressions; entity decoding and NFC, which have no JVM built-in, see only
the values that need them.  Truncation is a native expression on the
cleaned text.  The row count never changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import clean_columns, truncate_text

REQUIRED_STR = ("source", "title", "text", "url", "query", "target", "domain")
OPTIONAL_STR = ("author", "language")


def clean_records(df: DataFrame, max_text_len: int = P.MAX_TEXT_LENGTH) -> DataFrame:
    cleaned = clean_columns(df, [c for c in REQUIRED_STR + OPTIONAL_STR if c in df.columns])
    last = {c: F.when(F.col(c) != "", F.col(c)) for c in OPTIONAL_STR if c in df.columns}
    if "text" in df.columns:
        last["text"] = truncate_text("text", max_text_len)
    return cleaned.withColumns(last) if last else cleaned
