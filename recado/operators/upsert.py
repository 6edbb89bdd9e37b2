"""New results over stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recado.functions import text as t
from recado.operators.skew import salted_anti_join

KEY = ("interaction_date", "user_name", "original_text")


def upsert_results(stored: DataFrame, new: DataFrame, text: str = "original_text",
                   others: Sequence[str] = ("interaction_date", "user_name")) -> DataFrame:
    """Stored rows whose date, user and text do not recur in ``new``, then all of ``new``.

    NULLs in the key compare equal. The text takes part as a digest. Write the result to a new path: it
    reads the stored one.
    """
    keyed = stored.withColumn("_text_key", t.text_key(F.col(text)))
    keys = new.select(*others, t.text_key(F.col(text)).alias("_text_key"))
    row_id = [c for c in stored.columns if c != text] or [text]
    left = salted_anti_join(keyed, keys, [*others, "_text_key"], row_id=row_id).drop("_text_key")
    return left.unionByName(new)
