"""Times the batch operators on a generated feed of chosen density, to compare plans.

    python bench_dense.py TICKS TICKS_PER_SECOND_AND_SYMBOL

20 symbols, 8 cores; seconds per run, the better of two after a warm-up. One
line per plan.
"""

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tickloom as tl
from bench import session

SYMBOLS = 20


def feed(spark: SparkSession, ticks: int, rate: float) -> DataFrame:
    apart = int(1_000_000 / (rate * SYMBOLS))
    return spark.range(ticks).select(
        (F.col("id") % SYMBOLS).cast("string").alias("symbol"),
        (100 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("price"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * apart).alias("timestamp"),
    )


def union_of_widths(ticks: DataFrame) -> DataFrame:
    """The plan streams use: one aggregate per width."""
    found = None
    for w in tl.SIX:
        one = tl.window_stats(ticks, [w])
        found = one if found is None else found.unionByName(one)
    return found


PLANS = {
    "window_stats, one aggregate": tl.window_stats,
    "window_stats, rollup": lambda t: tl.window_stats(t, rollup=True),
    "window_stats, union of six": union_of_widths,
    "zscore_rows, join per width": lambda t: tl.zscore_rows(t, tl.window_stats(t)),
    "tick_zscores, join per part": tl.tick_zscores,
    "zscores": tl.zscores,
    "first_move by symbol": lambda t: tl.first_move(t, partition_cols=("symbol",)),
}


def main() -> None:
    ticks, rate = int(sys.argv[1]), float(sys.argv[2])
    spark = tl.configure(session())
    data = feed(spark, ticks, rate)
    for name, operator in PLANS.items():
        times = []
        for _ in range(3):
            start = time.perf_counter()
            operator(data).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        print(f"{name}: {min(times[1:]):.2f} s", flush=True)


if __name__ == "__main__":
    main()
