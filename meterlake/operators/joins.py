"""Equi-joins whose large side may concentrate on a few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_SALTS = "_salts"
_SALT = "_salt"


def hot_keys(big: DataFrame, key: str, tasks: int, factor: float = 2.0) -> dict:
    """Keys with more than ``factor`` times the mean task's rows, and the number
    of salts that brings each part of such a key down to that mean.

    Counted once, by a partial aggregate; a key is hot relative to the rows
    of the table, so at most ``tasks / factor`` keys are, at any size, and only
    they reach the driver.
    """
    seen = Observation("rows by key")
    most = int(tasks / factor) + 1
    counts = big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = counts.observe(seen, F.sum("n").alias("rows")).orderBy(F.col("n").desc()).limit(most).collect()
    total = (seen.get["rows"] or 0) if top else 0
    mean = max(1.0, total / tasks)
    return {r[key]: -(-r["n"] // int(mean)) for r in top if r["n"] > factor * mean}


def skew_safe_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Join ``big`` to ``small`` on ``key`` without a hot key landing whole
    in one task.

    The rows of a hot key (see ``hot_keys``) in ``big`` are spread over as many
    salts as the key has mean task shares, by a hash of the whole row, and only
    the hot keys' rows in ``small`` are replicated once per salt; every other
    key keeps salt 0. The join then runs on (key, salt). Each ``big`` row
    meets exactly one copy of each matching ``small`` row, so the result
    equals the plain join. ``how`` is "inner" or "left"; ``tasks`` is the
    number of shuffle partitions unless given.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_safe_join supports inner and left joins")
    spark = big.sparkSession
    hot = hot_keys(big, key, tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not hot:
        return big.join(small, key, how)
    salts = F.lit(1)
    for value, n in hot.items():
        salts = F.when(F.col(key) == F.lit(value), n).otherwise(salts)
    row = F.xxhash64(*[F.col(c) for c in big.columns])
    big_salted = big.withColumn(_SALTS, salts).withColumn(_SALT, F.pmod(row, F.col(_SALTS)).cast("int")).drop(_SALTS)
    small_salted = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    return big_salted.join(small_salted, [key, _SALT], how).drop(_SALT)
