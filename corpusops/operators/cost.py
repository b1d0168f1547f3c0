"""Container, storage and host cost analysis.

A sample is one reading of a container: ``name, ts, sample_id, cpu_stats, precpu_stats,
memory_stats, runtime, device_requests`` with cumulative CPU counters before and after.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: example rates, hours, and the limits of the advice rules
RATES = {
    "cpu_hour": 0.048, "memory_gb_hour": 0.0067, "storage_gb_month": 0.10, "gpu_hour": 1.52, "network_gb": 0.09,
}
GIB = 1024 ** 3
HOURS_PER_MONTH = 24 * 30
MONTHS = 12
LOW_CPU, LOW_CPU_COST, DOWNSIZE_SAVING = 10, 50, 0.3
HIGH_COST, GPU_LOW_CPU, LARGE_VOLUME_GB, HIGH_TOTAL, MANY_CONTAINERS = 100, 20, 10, 500, 5
BUSY_PERCENT = 90


def rate_card(spark: SparkSession, overrides: Mapping[str, float] | str | None = None) -> DataFrame:
    """``rate, value`` rows: the defaults, replaced by any overriding rates (mapping or JSON file)."""
    defaults = spark.createDataFrame(list(RATES.items()), "rate string, default double")
    if overrides is None:
        return defaults.withColumnRenamed("default", "value")
    if isinstance(overrides, str):
        fields = ", ".join(f"{name} double" for name in RATES)
        row = spark.read.schema(fields).json(overrides, multiLine=True)
        given = row.unpivot([], list(RATES), "rate", "value")
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in overrides.items()], "rate string, value double")
    # the card has five rows
    return defaults.join(F.broadcast(given), "rate", "left").select(
        "rate", F.coalesce("value", "default").alias("value")
    )


def _rates(card: DataFrame | None) -> dict[str, float]:
    """The card's five values as literals for expressions."""
    return dict(RATES) if card is None else {r["rate"]: r["value"] for r in card.collect()}


def _raw_cpu() -> Column:
    cpu = F.col("cpu_stats.cpu_usage.total_usage") - F.col("precpu_stats.cpu_usage.total_usage")
    system = F.col("cpu_stats.system_cpu_usage") - F.col("precpu_stats.system_cpu_usage")
    used = F.try_divide(cpu.cast("double"), system.cast("double")) * 100
    return F.coalesce(F.when(system > 0, used), F.lit(0.0))


def cpu_percent() -> Column:
    """CPU share between the two readings, at most 100; 0 without a positive system delta."""
    return F.least(_raw_cpu(), F.lit(100.0))


def memory_gb(usage: Column) -> Column:
    return usage.cast("double") / GIB


def uses_gpu() -> Column:
    requested = F.coalesce(F.size("device_requests") > 0, F.lit(False))
    return F.coalesce(F.col("runtime") == "nvidia", F.lit(False)) | requested


def latest_samples(samples: DataFrame) -> DataFrame:
    """Each container's newest sample, by a max over structs (combined before the shuffle)."""
    others = [c for c in samples.columns if c not in ("name", "ts", "sample_id")]
    newest = F.max_by(F.struct("ts", "sample_id", *others), F.struct("ts", "sample_id"))
    return samples.groupBy("name").agg(newest.alias("s")).select("name", "s.*")


def container_costs(samples: DataFrame, card: DataFrame | None = None) -> DataFrame:
    """Usage and hourly and monthly cost of every sample."""
    rates = _rates(card)
    hourly = (
        F.col("cpu_usage_percent") / 100 * rates["cpu_hour"]
        + F.col("memory_usage_gb") * rates["memory_gb_hour"]
        + F.when(F.col("uses_gpu"), rates["gpu_hour"]).otherwise(0.0)
    )
    keep = [c for c in ("sample_id", "ts") if c in samples.columns]
    return (
        samples.select(
            "name", *keep, cpu_percent().alias("cpu_usage_percent"),
            memory_gb(F.col("memory_stats.usage")).alias("memory_usage_gb"), uses_gpu().alias("uses_gpu"),
        )
        .withColumn("hourly_cost", hourly)
        .withColumn("monthly_cost", F.col("hourly_cost") * HOURS_PER_MONTH)
    )


def cost_totals(costs: DataFrame) -> DataFrame:
    return costs.agg(
        F.count("*").alias("containers"),
        F.coalesce(F.sum("hourly_cost"), F.lit(0.0)).alias("total_hourly_cost"),
    ).withColumn("total_monthly_cost", F.col("total_hourly_cost") * HOURS_PER_MONTH)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``volume, path, size_bytes`` of all files below ``folder/<volume>/``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.regexp_extract("path", folder.rstrip("/").rsplit("/", 1)[-1] + "/([^/]+)/", 1)
    return files.select(name.alias("volume"), "path", F.col("length").alias("size_bytes"))


def volume_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("volume").agg((F.sum("size_bytes").cast("double") / GIB).alias("size_gb"))


def storage_costs(sizes: DataFrame, card: DataFrame | None = None) -> DataFrame:
    return sizes.withColumn("monthly_cost", F.col("size_gb") * _rates(card)["storage_gb_month"])


def storage_totals(storage: DataFrame) -> DataFrame:
    return storage.agg(
        F.coalesce(F.sum("size_gb"), F.lit(0.0)).alias("total_storage_gb"),
        F.coalesce(F.sum("monthly_cost"), F.lit(0.0)).alias("monthly_storage_cost"),
    )


def container_recommendations(costs: DataFrame) -> DataFrame:
    """Downsize, spot and rebalance advice per container."""
    nothing = F.lit(None).cast("double")
    advice = lambda rule, saving: F.struct(F.lit(rule).alias("rule"), saving.alias("monthly_saving"))
    low = (F.col("cpu_usage_percent") < LOW_CPU) & (F.col("monthly_cost") > LOW_CPU_COST)
    dear = (F.col("monthly_cost") > HIGH_COST) & ~F.col("uses_gpu")
    idle_gpu = F.col("uses_gpu") & (F.col("cpu_usage_percent") < GPU_LOW_CPU)
    found = F.array_compact(F.array(
        F.when(low, advice("downsize", F.round(F.col("monthly_cost") * DOWNSIZE_SAVING, 2))),
        F.when(dear, advice("optimise_or_spot", nothing)),
        F.when(idle_gpu, advice("rebalance_gpu", nothing)),
    ))
    return costs.select(F.col("name").alias("target"), F.inline(found), F.col("monthly_cost").alias("amount"))


def storage_recommendations(storage: DataFrame) -> DataFrame:
    return storage.where(F.col("size_gb") > LARGE_VOLUME_GB).select(
        F.col("volume").alias("target"), F.lit("clean_or_archive").alias("rule"),
        F.lit(None).cast("double").alias("monthly_saving"), F.col("monthly_cost").alias("amount"),
    )


def total_recommendations(costs: DataFrame, storage: DataFrame) -> DataFrame:
    """Advice about the total cost and the number of containers."""
    row = cost_totals(costs).withColumn(
        "total", F.col("total_monthly_cost") + storage_totals(storage).select("monthly_storage_cost").scalar()
    )
    cell = lambda rule, amount: F.struct(
        F.lit("total").alias("target"), F.lit(rule).alias("rule"),
        F.lit(None).cast("double").alias("monthly_saving"), amount.cast("double").alias("amount"),
    )
    found = F.array_compact(F.array(
        F.when(F.col("total") > HIGH_TOTAL, cell("autoscale_or_shut_down", F.col("total"))),
        F.when(F.col("containers") > MANY_CONTAINERS, cell("orchestrate", F.col("containers"))),
    ))
    return row.select(F.inline(found))


def recommend(costs: DataFrame, storage: DataFrame) -> DataFrame:
    """All advice as ``target, rule, monthly_saving, amount``."""
    return (
        container_recommendations(costs)
        .unionByName(storage_recommendations(storage))
        .unionByName(total_recommendations(costs, storage))
    )


def savings(recommendations: DataFrame) -> DataFrame:
    """Sum of the savings as rounded to cents, and per year."""
    cents = F.sum(F.col("monthly_saving").cast("decimal(18,2)"))
    return recommendations.agg(
        F.coalesce(cents.cast("double"), F.lit(0.0)).alias("monthly_savings")
    ).withColumn("annual_savings", F.col("monthly_savings") * MONTHS)


def cost_report(samples: DataFrame, files: DataFrame, card: DataFrame | None = None) -> DataFrame:
    """One row: hourly cost (containers), monthly and annual cost (with storage), savings, and how much advice there is.

    The advice itself is the frame that ``recommend`` returns, all of it.
    """
    costs = container_costs(latest_samples(samples), card)
    storage = storage_costs(volume_sizes(files), card)
    advice = recommend(costs, storage)
    found = advice.agg(F.count("*").alias("n")).scalar()
    saved = savings(advice).select("monthly_savings").scalar()
    stored = storage_totals(storage).select("monthly_storage_cost").scalar()
    return cost_totals(costs).select(
        F.col("total_hourly_cost").alias("hourly_cost"),
        (F.col("total_monthly_cost") + stored).alias("monthly_cost"),
        ((F.col("total_monthly_cost") + stored) * MONTHS).alias("annual_cost"),
        saved.alias("monthly_savings"), found.alias("recommendations"),
    )


def container_advice(samples: DataFrame) -> DataFrame:
    """Scale up above 90 % CPU (not capped at 100 here), more memory above 90 % of the limit."""
    memory = F.try_divide(F.col("memory_stats.usage").cast("double"), F.col("memory_stats.limit").cast("double")) * 100
    cell = lambda advice, value: F.struct(F.lit(advice).alias("advice"), value.alias("percent"))
    found = F.array_compact(F.array(
        F.when(_raw_cpu() > BUSY_PERCENT, cell("scale_up", _raw_cpu())),
        F.when(memory > BUSY_PERCENT, cell("increase_memory", memory)),
    ))
    keep = [c for c in ("sample_id", "ts") if c in samples.columns]
    return samples.select("name", *keep, F.inline(found))


def cost_trend(costs: DataFrame, budget: float) -> DataFrame:
    """Cost per day, spend so far, the fitted line through the daily costs, and budget breach.

    Daily totals come first, so the windows run over one row per day.
    """
    daily = costs.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum(F.col("hourly_cost").cast("decimal(28,6)")).cast("double").alias("daily_cost")
    )
    by_day = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("double")
    line = daily.agg(F.struct(
        F.regr_slope("daily_cost", x).alias("slope"), F.regr_intercept("daily_cost", x).alias("intercept")
    )).scalar()
    summed = daily.withColumn("cumulative_cost", F.sum("daily_cost").over(by_day)).withColumn("line", line)
    return summed.select(
        "day", "daily_cost", "cumulative_cost", (F.col("line.intercept") + F.col("line.slope") * x).alias("projected_cost"),
        (F.col("cumulative_cost") > budget).alias("over_budget"),
    )


def projected_costs(trend: DataFrame, days: Sequence[int]) -> DataFrame:
    """Continue the fitted line ``days`` days past the last one."""
    ends = trend.agg(
        F.max("day").alias("last"), F.max_by("projected_cost", "day").alias("at_last"),
        F.regr_slope("projected_cost", F.datediff("day", F.lit("1970-01-01").cast("date"))).alias("slope"),
    )
    ahead = F.explode(F.array(*[F.lit(d) for d in days]))
    return ends.select("*", ahead.alias("ahead")).select(
        F.date_add("last", F.col("ahead")).alias("day"),
        (F.col("at_last") + F.col("slope") * F.col("ahead")).alias("projected_cost"),
    )
