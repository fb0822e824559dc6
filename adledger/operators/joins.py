"""Joins whose plan does not depend on how the keys are spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of one key are dealt over.
SALTS = 16


def salted_left_join(rows: DataFrame, few: DataFrame, keys: list[str], spread: list[str], salts: int = SALTS) -> DataFrame:
    """``rows`` left joined with ``few`` on ``keys``; a key's rows are dealt over ``salts`` parts by ``spread``.

    ``few`` (budgets, match types: a handful of rows a key) is replicated once for
    each part.  A key that holds a third of all rows is then ``salts`` tasks' work,
    also where the join's input is not an exchange that AQE could split.
    """
    salt = "__salt"
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, salt], "left").drop(salt)
