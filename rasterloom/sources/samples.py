"""Tables of resource samples as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The names, order and types of the columns are a data contract.
METRICS = ("proc_cpu_pct", "proc_rss_bytes", "system_cpu_pct", "gpu_util_pct", "gpu_mem_used_mib")
SAMPLES = (
    "t double, proc_cpu_pct double, proc_rss_bytes double, system_cpu_pct double, gpu_util_pct double, gpu_mem_used_mib double, "
    "gpu_mem_total_mib double, mac_gpu_model string, mac_gpu_vram_mib double, mac_process_uses_metal boolean"
)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The samples of CSV files with a header; an empty field is null, the header must have these names."""
    return spark.read.csv(path, header=True, enforceSchema=False, schema=SAMPLES)


def write_samples(samples: DataFrame, path: str) -> None:
    """Samples as CSV with a header, sorted by time; a missing column or null is an empty field, others are left out.

    Files follow each other in time; a table without rows gives one file with the header.
    """
    kinds = [part.strip().split(" ") for part in SAMPLES.split(",")]
    columns = [f"cast({name if name in samples.columns else 'null'} as {kind}) as {name}" for name, kind in kinds]
    samples.selectExpr(*columns).orderBy("t").write.mode("overwrite").csv(path, header=True, emptyValue="")
