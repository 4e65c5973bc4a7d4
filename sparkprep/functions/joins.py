"""Join helper for tables with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str] | str,
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Join ``big`` to a table with one row per key (levels, statistics).

    No hint and no probe: Spark compares the table's bytes with
    ``spark.sql.autoBroadcastJoinThreshold``, at planning and again with the
    bytes that its stages produced, and otherwise shuffles; adaptive execution
    then splits a hot key's partition. ``salts`` asks for a salted join
    instead (for full joins, or where skew handling is off): each row of
    ``big`` draws its sub-key by its own number, so equal rows are spread too,
    and ``small`` is repeated per salt."""
    keys = [on] if isinstance(on, str) else list(on)
    if not salts:
        return big.join(small, keys, how)
    salt = "__salt"
    big_s = big.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    small_s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return big_s.join(small_s, keys + [salt], how).drop(salt)
