"""Names for helper columns beside those of a caller's table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare(df: DataFrame, name: str) -> str:
    """The name, lengthened until the table has no such column, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key() -> Column:
    """Names a document by its doc_id and text, so that rows can be told apart and found again."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
