"""Joins in which a hot key's rows are dealt to many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks that one key's rows are dealt to at most.
SALTS = 64


def dealt(big: DataFrame, spread: Column) -> DataFrame:
    """big with __salt: its rows of a key go to SALTS places by spread, a function of the row alone. What is to meet them must be
    sent to those of the places that have any."""
    return big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
