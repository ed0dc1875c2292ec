"""Monitoring of workers: samples of process, host, GPUs and model host, and their summaries by run.

Samples are rows (``SAMPLE``); absent values are null and count nowhere. Summaries are grouped aggregates, so a
run of any length needs no series in memory, except for the two nearest-rank percentiles.
"""

from __future__ import annotations

import os
import resource
import shutil
import socket
import subprocess
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

GPU = (
    "struct<index:int,uuid:string,name:string,utilization_percent:double,memory_used_mb:double,memory_total_mb:double,temperature_c:double,power_draw_w:double,"
    "power_limit_w:double,fan_speed_percent:double,clock_sm_mhz:double,clock_memory_mhz:double,performance_state:string,throttling_active:boolean,throttling_reasons:array<string>>"
)
MODEL = "struct<name:string,size_vram_mb:double,context_length:bigint,parameter_size:string,quantization_level:string>"
SAMPLE = (
    "run_id string, worker string, ts timestamp, process struct<rss_mb:double,cpu_percent:double,cpu_seconds:double>, "
    "host struct<memory_available_mb:double,swap_free_mb:double,disk_free_gb:double,disk_used_percent:double,load_1m:double,cpu_percent:double,temperature_max_c:double>, "
    f"gpus array<{GPU}>, ollama struct<available:boolean,disabled:boolean,error:string,host:string,models:array<{MODEL}>>"
)
#: Queried fields of a device, in the order of GPU from its index to its clocks.
GPU_QUERY = "index,uuid,name,utilization.gpu,memory.used,memory.total,temperature.gpu,power.draw,power.limit,fan.speed,clocks.sm,clocks.mem,pstate"


def _number(value: str) -> float | None:
    try:
        return float(value)
    except ValueError:
        return None


def _meminfo() -> dict[str, float]:
    found = {}
    try:
        with open("/proc/meminfo", encoding="ascii") as lines:
            for line in lines:
                name, _, value = line.partition(":")
                found[name] = int(value.split()[0]) / 1024
    except (OSError, ValueError, IndexError):
        pass
    return found


def _devices() -> list[dict]:
    """What the first installed device tool says of each device; empty without one."""
    try:
        out = subprocess.run(["nvidia-smi", f"--query-gpu={GPU_QUERY}", "--format=csv,noheader,nounits"], capture_output=True, text=True, timeout=5, check=True).stdout
    except (OSError, subprocess.SubprocessError):
        return []
    names = "index uuid name utilization_percent memory_used_mb memory_total_mb temperature_c power_draw_w power_limit_w fan_speed_percent clock_sm_mhz clock_memory_mhz performance_state".split()
    rows = []
    for line in out.splitlines():
        cells = [c.strip() for c in line.split(",")]
        if len(cells) == len(names):
            row = {n: c if n in ("uuid", "name", "performance_state") else _number(c) for n, c in zip(names, cells)}
            rows.append(row | {"index": int(row["index"] or 0), "throttling_active": None, "throttling_reasons": []})
    return rows


def measure(run_id: str) -> dict:
    """One sample of this process and its host."""
    use, memory = resource.getrusage(resource.RUSAGE_SELF), _meminfo()
    disk = shutil.disk_usage("/")
    return {
        "run_id": run_id,
        "worker": f"{socket.gethostname()}:{os.getpid()}",
        "ts": pa.scalar(time.time_ns() // 1000, pa.timestamp("us", "UTC")).as_py(),
        "process": {"rss_mb": use.ru_maxrss / 1024, "cpu_percent": None, "cpu_seconds": use.ru_utime + use.ru_stime},
        "host": {
            "memory_available_mb": memory.get("MemAvailable"),
            "swap_free_mb": memory.get("SwapFree"),
            "disk_free_gb": disk.free / 1e9,
            "disk_used_percent": 100.0 * disk.used / disk.total,
            "load_1m": os.getloadavg()[0],
            "cpu_percent": None,
            "temperature_max_c": None,
        },
        "gpus": _devices(),
        "ollama": None,
    }


def sample(spark: SparkSession, run_id: str, tasks: int | None = None) -> DataFrame:
    """A sample of each worker that runs one of ``tasks`` tasks; append it to a table while a run goes on."""
    schema = spark.createDataFrame([], SAMPLE).schema
    arrow = to_arrow_schema(schema, timestamp_utc=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_pylist([measure(run_id)], schema=arrow)

    n = tasks or spark.sparkContext.defaultParallelism
    return spark.range(n, numPartitions=n).mapInArrow(run, schema)


def run_summary(samples: DataFrame) -> DataFrame:
    """One row for each run: averages and extremes of process, host, devices and model host, rounded to three places."""
    p95 = lambda c, name: F.round(F.expr(f"percentile_disc(0.95) within group (order by {c})"), 3).alias(name)
    host = samples.groupBy("run_id").agg(
        F.count("*").alias("sample_count"),
        F.round(F.max("process.rss_mb"), 3).alias("process_rss_peak_mb"),
        F.round(F.avg("process.cpu_percent"), 3).alias("process_cpu_percent_avg"),
        F.round(F.max("process.cpu_percent"), 3).alias("process_cpu_percent_max"),
        F.when(F.count("process.cpu_seconds") >= 2, F.round(F.max("process.cpu_seconds") - F.min("process.cpu_seconds"), 3)).alias("process_cpu_seconds"),
        F.round(F.avg("host.memory_available_mb"), 3).alias("memory_available_avg_mb"),
        F.round(F.min("host.memory_available_mb"), 3).alias("memory_available_min_mb"),
        F.round(F.min("host.swap_free_mb"), 3).alias("swap_free_min_mb"),
        F.round(F.min("host.disk_free_gb"), 3).alias("disk_free_min_gb"),
        F.round(F.max("host.disk_used_percent"), 3).alias("disk_used_percent_max"),
        F.round(F.avg("host.load_1m"), 3).alias("load_1m_avg"),
        F.round(F.max("host.load_1m"), 3).alias("load_1m_max"),
        F.round(F.avg("host.cpu_percent"), 3).alias("host_cpu_percent_avg"),
        F.round(F.max("host.cpu_percent"), 3).alias("host_cpu_percent_max"),
        F.round(F.avg("host.temperature_max_c"), 3).alias("host_temperature_avg_c"),
        p95("host.temperature_max_c", "host_temperature_p95_c"),
        F.round(F.max("host.temperature_max_c"), 3).alias("host_temperature_max_c"),
        F.bool_or(F.coalesce("ollama.available", F.lit(False))).alias("ollama_api_available"),
        F.round(F.max(F.when(F.col("ollama").isNotNull(), F.aggregate(F.coalesce("ollama.models", F.array().cast(f"array<{MODEL}>")), F.lit(0.0), lambda a, m: a + F.coalesce(m["size_vram_mb"], F.lit(0.0))))), 3).alias("ollama_vram_loaded_peak_mb"),
    )
    each = samples.select("run_id", F.explode("gpus").alias("g")).select("run_id", "g.*")
    gpus = each.groupBy("run_id").agg(
        F.round(F.avg("utilization_percent"), 3).alias("gpu_utilization_avg_percent"),
        p95("utilization_percent", "gpu_utilization_p95_percent"),
        F.round(F.max("utilization_percent"), 3).alias("gpu_utilization_max_percent"),
        F.round(F.max("memory_used_mb"), 3).alias("gpu_memory_peak_mb"),
        F.round(F.avg("temperature_c"), 3).alias("gpu_temperature_avg_c"),
        F.round(F.max("temperature_c"), 3).alias("gpu_temperature_max_c"),
        F.round(F.avg("power_draw_w"), 3).alias("gpu_power_draw_avg_w"),
        F.round(F.max("power_draw_w"), 3).alias("gpu_power_draw_max_w"),
        F.round(F.max("fan_speed_percent"), 3).alias("gpu_fan_speed_max_percent"),
        F.coalesce(F.bool_or("throttling_active"), F.lit(False)).alias("throttling_detected"),
    )
    return host.join(gpus, "run_id", "left")


def device_summary(samples: DataFrame) -> DataFrame:
    """One row for each run and device, named by its uuid, else its index."""
    identity = F.coalesce(F.col("g.uuid"), F.col("g.index").cast("string"), F.lit("unknown"))
    each = samples.select("run_id", "ts", F.explode("gpus").alias("g")).select("run_id", "ts", identity.alias("id"), "g.*")
    peaks = {"utilization_percent": "utilization_max_percent", "memory_used_mb": "memory_peak_mb", "memory_total_mb": "memory_total_mb", "temperature_c": "temperature_max_c", "power_draw_w": "power_draw_max_w"}
    peaks |= {"power_limit_w": "power_limit_w", "fan_speed_percent": "fan_speed_max_percent", "clock_sm_mhz": "clock_sm_max_mhz", "clock_memory_mhz": "clock_memory_max_mhz"}
    return each.groupBy("run_id", "id").agg(
        F.min_by("index", "ts").alias("index"),
        F.min_by("name", "ts").alias("name"),
        (F.count("throttling_active") > 0).alias("throttling_observed"),
        F.coalesce(F.bool_or("throttling_active"), F.lit(False)).alias("throttling_detected"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("throttling_reasons", F.array().cast("array<string>")))))).alias("throttling_reasons_seen"),
        F.array_sort(F.collect_set("performance_state")).alias("performance_states_seen"),
        *[F.round(F.max(c), 3).alias(name) for c, name in peaks.items()],
    )


def model_summary(samples: DataFrame) -> DataFrame:
    """One row for each run and model that the model host had loaded."""
    each = samples.select("run_id", "ts", F.explode("ollama.models").alias("m")).select("run_id", "ts", F.coalesce("m.name", F.lit("unknown")).alias("model"), "m.*")
    return each.groupBy("run_id", "model").agg(
        F.round(F.max(F.coalesce("size_vram_mb", F.lit(0.0))), 3).alias("vram_peak_mb"),
        F.max(F.coalesce("context_length", F.lit(0))).alias("context_length_max"),
        F.max_by("parameter_size", "ts").alias("parameter_size"),
        F.max_by("quantization_level", "ts").alias("quantization_level"),
    )
