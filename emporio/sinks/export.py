"""Exports, audit rows and isolated task runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame


def export(frames: Mapping[str, DataFrame], root: str, compression: str = "zstd") -> list[str]:
    """Write each table as compressed Parquet under ``root``."""
    paths = []
    for name, df in frames.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
            "compression", compression
        ).parquet(path)
        paths.append(path)
    return paths


def append_audit(df: DataFrame, path: str) -> None:
    """Append result rows as JSON lines."""
    df.write.mode("append").json(path)


@dataclass(frozen=True)
class TaskResult:
    name: str
    ok: bool
    value: object = None
    error: str | None = None


def run_all(tasks: Mapping[str, Callable[[], object]], parallel: int = 1) -> list[TaskResult]:
    """Run independent jobs; one failing does not stop the others.

    Threads only submit jobs: Spark schedules the work of several at once.
    """

    def run(item: tuple[str, Callable[[], object]]) -> TaskResult:
        name, task = item
        try:
            return TaskResult(name, True, task())
        except Exception as exc:  # noqa: BLE001 - reported to the caller
            return TaskResult(name, False, error=f"{type(exc).__name__}: {exc}")

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(run, tasks.items()))
