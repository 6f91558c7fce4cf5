"""Column masks and tokenisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_email(email: str | Column) -> Column:
    """First two characters, then a fixed tail; null stays null."""
    return F.concat(F.left(email, F.lit(2)), F.lit("***@***.invalid"))


def mask_pan(token: str | Column) -> Column:
    """Fixed head, then the last four characters; null stays null."""
    return F.concat(F.lit("tok_****"), F.right(token, F.lit(4)))


def pan_token(account_id: str | Column, salt: int | str = 42) -> Column:
    """``tok_`` and the first 16 hex digits of a salted SHA-256 of the account id."""
    col = F.col(account_id) if isinstance(account_id, str) else account_id
    salted = F.concat(F.lit("pan|"), col.cast("string"), F.lit(f"|{salt}"))
    return F.concat(F.lit("tok_"), F.substring(F.sha2(salted, 256), 1, 16))


def tokenize(df: DataFrame, col: str, salt: int | str = 42, out: str = "pan_token") -> DataFrame:
    """Adds the token of ``col`` and leaves the rest as it is."""
    return df.withColumn(out, pan_token(col, salt))
