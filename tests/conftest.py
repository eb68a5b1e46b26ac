from __future__ import annotations

import os
import sys
from datetime import date, datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emporio.registry import TABLES, TABLES_BY_NAME  # noqa: E402
from emporio.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "emporio-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.driver.host": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """A UTC timestamp from ``YYYY-MM-DD[ HH:MM]``."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def day(text: str) -> date:
    return date.fromisoformat(text)


def source_rows(spark, table: str, rows: list[dict], ingested: str | None = None):
    """Rows of a source table; columns not given are NULL."""
    entry = TABLES_BY_NAME[table]
    schema = entry.staging_schema if ingested else entry.source_schema
    extra = {"_ingested_at": at(ingested)} if ingested else {}
    defaults = {"updated_at": at("2026-01-01")}
    full = [{**defaults, **extra, **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in full], schema)


def staged(spark, tables: dict[str, list[dict]], ingested: str = "2026-01-02") -> dict:
    """All staged tables by model name, empty where not given."""
    return {
        e.staging_name: source_rows(spark, e.full_name, tables.get(e.full_name, []), ingested) for e in TABLES
    }


def rows_by(df, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
