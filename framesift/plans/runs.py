"""Run statistics, backend comparison and parameter sweeps."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.config import RunConfig
from framesift.functions.assets import format_cell, safe_rate
from framesift.plans.captioning import run
from framesift.sources.results import count_rows

RUN_SCHEMA = (
    "backend string, elapsed_sec double, output string, batch_size int, gpu_concurrency int, "
    "limit int, error string, rows bigint, throughput double"
)


def run_once(
    spark: SparkSession, manifest, output: str, config: RunConfig, limit: int | None = None, **options
) -> dict:
    """Statistics of one run; a failed run has an error text and no elapsed time."""
    try:
        return run(spark, manifest, output, config, limit, **options) | {"error": None}
    except Exception as problem:
        return {
            "backend": config.backend,
            "elapsed_sec": None,
            "output": output,
            "batch_size": config.batch_size,
            "gpu_concurrency": config.gpu_concurrency,
            "limit": limit,
            "error": str(problem),
        }


def runs_table(spark: SparkSession, stats: Iterable[dict]) -> DataFrame:
    """Statistics as a table, with the rows each run wrote and its throughput. Runs have
    counted their rows themselves; of one that failed, what stands in its folder counts."""
    names = ["backend", "elapsed_sec", "output", "batch_size", "gpu_concurrency", "limit", "error"]
    counted = [
        tuple(one.get(name) for name in names)
        + (one["rows"] if "rows" in one else count_rows(spark, one["output"]), None)
        for one in stats
    ]
    table = spark.createDataFrame(counted, RUN_SCHEMA)
    return table.withColumn("throughput", safe_rate("rows", "elapsed_sec"))


def record_runs(spark: SparkSession, stats: Iterable[dict], path: str) -> None:
    runs_table(spark, stats).coalesce(1).write.mode("append").parquet(path)


def add_throughput(runs: DataFrame, rows="rows", elapsed="elapsed_sec") -> DataFrame:
    return runs.withColumn("throughput", safe_rate(rows, elapsed))


def compare_backends(
    runs: DataFrame, first: str, second: str, order: str, by: Sequence[str] = ()
) -> DataFrame:
    """The first run of two backends side by side, with the second one's speedup.

    Columns are ``<backend>_<metric>``; a backend without a run gives nulls, and so
    no speedup or winner.
    """
    metrics = ["elapsed_sec", "rows", "throughput", "batch_size"]
    earliest = F.min_by(F.struct(*metrics), order)
    wide = runs.groupBy(*by).pivot("backend", [first, second]).agg(earliest)

    def metric(backend: str, name: str) -> Column:
        return F.col(f"`{backend}`.{name}")

    a, b = metric(first, "elapsed_sec"), metric(second, "elapsed_sec")
    speedup = F.when((a > 0) & (b > 0), a / b)
    return wide.select(
        *by,
        *[metric(x, name).alias(f"{x}_{name}") for name in metrics for x in (first, second)],
        speedup.alias("speedup"),
        F.when(speedup > 1, second).when(speedup.isNotNull(), first).alias("faster"),
    )


def comparison_cells(compared: DataFrame, first: str, second: str) -> DataFrame:
    """The comparison as text cells, one row per metric, a dash where unknown."""
    shown = [
        ("Elapsed seconds", "elapsed_sec", 1),
        ("Captions", "rows", None),
        ("Assets per second", "throughput", 2),
        ("Assets per call", "batch_size", None),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                format_cell(f"{first}_{name}", digits).alias(first),
                format_cell(f"{second}_{name}", digits).alias(second),
            )
            for label, name, digits in shown
        ]
    )
    return compared.select(F.explode(rows).alias("cell")).select("cell.*")


def sweep_configs(
    base: RunConfig, batch_sizes: Sequence[int], concurrencies: Sequence[int]
) -> list[RunConfig]:
    return [
        replace(base, batch_size=size, gpu_concurrency=workers)
        for size, workers in itertools.product(batch_sizes, concurrencies)
    ]


def sweep_grid(
    runs: DataFrame, batch_sizes: Sequence[int], concurrencies: Sequence[int]
) -> DataFrame:
    """Every row of ``runs`` once per pair of settings."""
    sizes = F.array(*[F.lit(size) for size in batch_sizes])
    workers = F.array(*[F.lit(count) for count in concurrencies])
    return runs.withColumn("batch_size", F.explode(sizes)).withColumn(
        "gpu_concurrency", F.explode(workers)
    )


def sweep(
    spark: SparkSession,
    manifest,
    output_root: str,
    base: RunConfig,
    batch_sizes: Sequence[int] = (1, 2, 4),
    concurrencies: Sequence[int] = (1, 2),
    **options,
) -> DataFrame:
    """One run per pair of settings, each into a folder of its own, as a run table."""
    stats = []
    for config in sweep_configs(base, batch_sizes, concurrencies):
        folder = f"{config.output_path(output_root)}-b{config.batch_size}-c{config.gpu_concurrency}"
        stats.append(run_once(spark, manifest, folder, config, **options))
    return runs_table(spark, stats)


def compare(
    spark: SparkSession,
    manifest,
    output_root: str,
    base: RunConfig,
    backends: Sequence[str] = ("batch", "request"),
    **options,
) -> DataFrame:
    """One run per backend with the same settings, as a run table."""
    configs = [replace(base, backend=backend) for backend in backends]
    stats = [
        run_once(spark, manifest, config.output_path(output_root), config, **options)
        for config in configs
    ]
    return runs_table(spark, stats)


def sweep_cells(runs: DataFrame) -> DataFrame:
    """Sweep report as text cells; unknown numbers are dashes."""
    return runs.select(
        "backend",
        "batch_size",
        "gpu_concurrency",
        format_cell("elapsed_sec", 1).alias("wall"),
        format_cell("throughput", 2).alias("throughput"),
        format_cell("rows").alias("rows"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def best_run(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The run with the highest throughput among those without an error."""
    columns = [c for c in runs.columns if c not in by]
    good = runs.where(F.col("error").isNull() & F.col("throughput").isNotNull())
    best = F.max_by(F.struct(*columns), F.struct("throughput", *[c for c in columns if c != "throughput"]))
    return good.groupBy(*by).agg(best.alias("best")).select(*by, "best.*")
