"""Raw request samples: totals, distribution, exact and approximate percentiles, warm-up."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchledger.session import settle

# The reported percentiles and the kinds of error a sample may have.
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
FIRST_ERROR_STATUS = 400
ERROR_OUTCOMES = ("connect", "read", "write", "status", "timeout")

# Leading binary digits that a coarse bin keeps in the first step of an exact percentile.
BIN_DIGITS = 9


def status_outcome(http_status: Column) -> Column:
    """``status`` for a response that counts as an error."""
    return F.when(http_status >= FIRST_ERROR_STATUS, F.lit("status")).otherwise(F.lit("ok"))


def sample_totals(samples: DataFrame, status_outcomes: tuple[str, ...] = ("status", "error")) -> DataFrame:
    """Duration, requests and errors by kind for every run."""
    kinds = [
        F.count_if(F.col("outcome").isin(*(status_outcomes if kind == "status" else (kind,)))).alias(f"{kind}_errors")
        for kind in ERROR_OUTCOMES
    ]
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return samples.groupBy("run_key").agg(
        (F.max(micros) - F.min(micros)).alias("duration_us"),
        F.count("*").alias("requests"),
        F.sum("latency_us").alias("latency_sum_us"),
        *kinds,
    )


def sample_stats(samples: DataFrame) -> DataFrame:
    """Smallest, mean, largest and sample standard deviation of the latency of every run.

    One aggregation sums the values and, of their upper and lower 32 bits, the products, as whole numbers that
    cannot overflow; a run's row then has all that its exact deviations from the whole part of its mean need.
    So no size of the values costs precision, and the result does not depend on the order of the rows. A
    run of one sample has no deviation.
    """
    high = F.shiftright("latency_us", 32)
    low = F.col("latency_us").bitwiseAND(F.lit(0xFFFFFFFF))

    def product(one: Column, other: Column) -> Column:
        wide = "decimal(19,0)"
        return F.sum((one.cast(wide) * other.cast(wide)).cast("decimal(38,0)"))

    sums = samples.groupBy("run_key").agg(
        F.count("*").alias("n"),
        F.min("latency_us").alias("min_us"),
        F.max("latency_us").alias("max_us"),
        F.sum(F.col("latency_us").cast("decimal(19,0)")).alias("_sum"),
        product(high, high).alias("_high"),
        product(high, low).alias("_both"),
        product(low, low).alias("_low"),
    )

    # A row per run; its whole numbers may have 60 digits, more than a decimal holds.
    @F.pandas_udf("off double, squares double")
    def deviations(rows: pd.DataFrame) -> pd.DataFrame:
        off, squares = [], []
        for n, total, high_, both, low_ in zip(*[map(int, rows[c]) for c in ("n", "_sum", "_high", "_both", "_low")], strict=True):
            middle = abs(total) // n * (1 if total >= 0 else -1)
            all_squares = (high_ << 64) + (both << 33) + low_
            off.append(float(total - n * middle))
            squares.append(float(all_squares - 2 * middle * total + n * middle * middle))
        return pd.DataFrame({"off": off, "squares": squares})

    measured = sums.withColumn("_dev", deviations(F.struct("n", "_sum", "_high", "_both", "_low")))
    n = F.col("n").cast("double")
    off, squares = F.col("_dev.off"), F.col("_dev.squares")
    variance = (squares - off * off / n) / (n - 1)
    return measured.select(
        "run_key",
        "n",
        "min_us",
        (F.col("_sum").cast("double") / n).alias("mean_us"),
        "max_us",
        F.when(F.col("n") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("stdev_us"),
    )


def _with_bin(counts: DataFrame) -> DataFrame:
    """Add a monotone coarse ``bin``: small values on their own, larger ones by leading binary digits."""
    shifted = counts.withColumn("_shift", F.greatest(F.length(F.bin("latency_us")) - BIN_DIGITS, F.lit(0)))
    leading = F.expr("shiftright(latency_us, _shift)") + F.col("_shift") * 2**BIN_DIGITS
    return shifted.withColumn("bin", F.when(F.col("latency_us") < 0, F.lit(-1)).otherwise(leading)).drop("_shift")


def sample_percentiles(samples: DataFrame, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """Exact nearest-rank percentiles per run: (run_key, percentile, latency_us).

    A run may hold any share of all samples, so no step gathers a run. Equal latencies are counted
    first (combined before the shuffle); coarse bins of those counts, of which a run has a few
    thousand at most, tell in which bin each rank lies; only inside such bins are single values
    accumulated.
    """
    counts = settle(samples.groupBy("run_key", "latency_us").agg(F.count("*").alias("copies")), "latencies")
    counts = _with_bin(counts)
    bins = counts.groupBy("run_key", "bin").agg(F.sum("copies").alias("copies"))
    whole_run = Window.partitionBy("run_key")
    upto = whole_run.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bins.select(
        "run_key",
        "bin",
        F.sum("copies").over(upto).alias("_upto"),
        (F.sum("copies").over(upto) - F.col("copies")).alias("_before"),
        F.sum("copies").over(whole_run).alias("_total"),
    )
    ranks = F.array(*[F.lit(p) for p in percentiles])
    # Rank of percentile p among n: p * n / 100 rounded up.
    asked = F.transform(
        ranks,
        lambda p: F.struct(
            p.alias("percentile"),
            F.ceil((p * F.col("_total")).cast("decimal(30,0)") / 100).cast("bigint").alias("rank"),
        ),
    )
    wanted = placed.select(
        "run_key",
        "bin",
        F.transform(
            F.filter(asked, lambda a: (a["rank"] > F.col("_before")) & (a["rank"] <= F.col("_upto"))),
            lambda a: F.struct(a["percentile"].alias("percentile"), (a["rank"] - F.col("_before")).alias("rank")),
        ).alias("wanted"),
    ).filter(F.size("wanted") > 0)
    in_bin = (
        Window.partitionBy("run_key", "bin").orderBy("latency_us").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    narrowed = counts.join(wanted, ["run_key", "bin"]).select(
        "run_key", "latency_us", "copies", "wanted", F.sum("copies").over(in_bin).alias("_upto")
    )
    met = F.filter(
        "wanted",
        lambda a: (a["rank"] > F.col("_upto") - F.col("copies")) & (a["rank"] <= F.col("_upto")),
    )
    return narrowed.select("run_key", F.explode(met).alias("_met"), "latency_us").select(
        "run_key", F.col("_met.percentile").alias("percentile"), "latency_us"
    )


def sample_percentiles_approx(
    samples: DataFrame, percentiles: tuple[int, ...] = PERCENTILES, accuracy: int = 10_000
) -> DataFrame:
    """The same shape within a rank error of n / accuracy, in one aggregation."""
    levels = [p / 100 for p in percentiles]
    sketched = samples.groupBy("run_key").agg(
        F.percentile_approx("latency_us", levels, accuracy).alias("_values")
    )
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in percentiles]).alias("percentile"), F.col("_values").alias("latency_us"))
    return sketched.select("run_key", F.explode(pairs).alias("_pair")).select("run_key", "_pair.*")


def rank_errors(samples: DataFrame, estimates: DataFrame) -> DataFrame:
    """``estimates`` with ``n`` and ``rank_error``: how far each lies from the rank it stands for, in ranks.

    An estimate covers the ranks of all samples equal to it.
    """
    wanted = F.ceil((F.col("percentile") * F.col("n")).cast("decimal(30,0)") / 100)
    counted = samples.groupBy("run_key", F.col("latency_us").alias("_value")).agg(F.count("*").alias("_copies"))
    below = F.sum(F.when(F.col("_value") < F.col("latency_us"), F.col("_copies")).otherwise(0))
    equal = F.sum(F.when(F.col("_value") == F.col("latency_us"), F.col("_copies")).otherwise(0))
    placed = (
        counted.join(estimates, "run_key")
        .groupBy("run_key", "percentile", "latency_us")
        .agg(below.alias("_below"), equal.alias("_equal"), F.sum("_copies").alias("n"))
    )
    error = F.greatest(F.lit(0), F.col("_below") + 1 - wanted, wanted - F.col("_below") - F.col("_equal"))
    return placed.select("run_key", "percentile", "latency_us", "n", error.cast("bigint").alias("rank_error"))


def after_warm_up(samples: DataFrame, warm_up_seconds: int) -> DataFrame:
    """Samples taken at least ``warm_up_seconds`` after the first one of their run.

    The first times are one small row per run; joining them back lets the engine split a hot run,
    which a window over the run could not.
    """
    first = samples.groupBy("run_key").agg(F.min("ts").alias("_first"))
    warm_up = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(warm_up_seconds))
    return samples.join(first, "run_key").filter(F.col("ts") >= F.col("_first") + warm_up).drop("_first")
