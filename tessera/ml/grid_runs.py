"""A grid of fits that survives being stopped.

Every point's metric is written to its own folder under a hash of its settings
and of the scope they were run in (data, split, seed).  A rerun skips the
points whose folder is complete, so a killed job goes on where it was.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "position int, settings string, metric double, seconds double"


def points_of(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations as settings by name, the last name changing fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def run_id(settings: Mapping, scope: str) -> str:
    return hashlib.md5(json.dumps([scope, settings], sort_keys=True).encode()).hexdigest()


def _finished(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def run_grid(spark: SparkSession, points: Sequence[Mapping], measure: Callable[[Mapping], float], table_path: str,
             scope: str, parallelism: int = 4) -> DataFrame:
    """(run_id, position, settings, metric, seconds): one row a point.

    ``measure`` fits one point and returns its metric.  At most ``parallelism``
    points run at once.  A point that fails does not stop the others; its error
    is raised when they are done, and only it is repeated by the next run.
    """
    table_path = table_path.rstrip("/")
    folders = {i: f"{table_path}/run_id={run_id(p, scope)}" for i, p in enumerate(points)}
    if len(set(folders.values())) < len(folders):
        raise ValueError("the grid holds a setting twice")

    def one(i: int) -> None:
        start = time.monotonic()
        metric = float(measure(points[i]))
        row = (i, json.dumps(points[i], sort_keys=True), metric, time.monotonic() - start)
        spark.createDataFrame([row], ROW).coalesce(1).write.mode("overwrite").parquet(folders[i])

    todo = [i for i, folder in folders.items() if not _finished(spark, folder)]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(one), i) for i in todo]
        errors = [e for e in (r.exception() for r in runs) if e is not None]
    if errors:
        raise errors[0]
    # the id is read as declared, and points of other grids in this table are left out
    wanted = [f.rsplit("=", 1)[1] for f in folders.values()]
    return spark.read.schema(f"{ROW}, run_id string").parquet(table_path).where(F.col("run_id").isin(wanted))


def best_settings(runs: DataFrame, larger: bool = True) -> dict:
    """Settings of the best metric, the first of equal ones."""
    order = F.desc_nulls_last("metric") if larger else F.asc_nulls_last("metric")
    return json.loads(runs.orderBy(order, "position").first()["settings"])
