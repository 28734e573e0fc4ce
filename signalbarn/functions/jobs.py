"""Running independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(
    spark: SparkSession, jobs: Iterable[Callable[[], None]], at_once: int = 6
) -> None:
    """Start each job from its own thread, so that small ones fill each other's gaps.

    The threads only submit work; the first error is raised after all have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in started:
        job.result()
