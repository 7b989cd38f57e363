"""Several writes at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

WIDTH = 4


def in_parallel(
    spark: SparkSession, jobs: Mapping[str, Callable[[], T]], width: int = WIDTH
) -> dict[str, T]:
    """Results by name; the first failure is raised once all jobs have ended.

    Each job waits for Spark in a thread of its own, so small tables are written
    in the executors that a large one leaves free.
    """
    with ThreadPoolExecutor(width) as pool:
        inherit = inheritable_thread_target(spark)
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}
