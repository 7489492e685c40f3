"""Rolling rate of calls, exact for accounts of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def rolling_count(df: DataFrame, account: str, ts: str, seconds: int, out: str = "calls") -> DataFrame:
    """Rows of the same account in the trailing window [ts - seconds, ts].

    An account is cut into time pieces as long as the window; each piece sees its own rows and those of
    the piece before it, so no task ever holds more than two windows of one account.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz"))
    width = seconds * 1_000_000
    timed = df.withColumn("_us", micros).withColumn("_piece", F.floor(F.col("_us") / width))
    halo = timed.select(account, "_us", (F.col("_piece") + 1).alias("_piece"), F.lit(True).alias("_halo"))
    both = timed.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(account, "_piece").orderBy("_us").rangeBetween(-width, 0)
    return (both.withColumn(out, F.count(F.lit(1)).over(w)).where(~F.col("_halo"))
            .select(*df.columns, out))


def over_quota(df: DataFrame, account: str, ts: str, seconds: int = 60, quota: int = 1000) -> DataFrame:
    """Calls that found their account above its quota, and the worst rate seen per account."""
    counted = rolling_count(df, account, ts, seconds)
    return counted.groupBy(account).agg(
        F.max("calls").alias("peak"), F.count_if(F.col("calls") > quota).alias("n_over"),
        F.count(F.lit(1)).alias("n_calls"))
