"""Audit log reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reconlake.operators import audit
from reconlake.queries import fixtures as fx
from reconlake.queries import query

_LAST = """last AS (SELECT table_name, status, event_time, run_id, rows_processed FROM log
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY event_time DESC, run_id DESC) = 1)"""
_LOG = fx.ctes(log=fx.AUDIT, tasks=fx.TASKS)


@query("audit_latest", f"{_LOG}, {_LAST} SELECT * FROM last")
def audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_status(fx.AUDIT.frame(spark, sf_dir))


def _pending_sql(statuses: str) -> str:
    return (
        f"{_LOG}, {_LAST} SELECT * FROM tasks WHERE table_name NOT IN "
        f"(SELECT table_name FROM last WHERE status IN ({statuses}))"
    )


@query("audit_pending", _pending_sql("'SUCCESS'"))
def audit_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.pending(fx.TASKS.frame(spark, sf_dir), fx.AUDIT.frame(spark, sf_dir))


@query("audit_pending_no_retry", _pending_sql("'SUCCESS', 'ERROR'"))
def audit_pending_no_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that failed are not tried again."""
    tasks, log = fx.TASKS.frame(spark, sf_dir), fx.AUDIT.frame(spark, sf_dir)
    return audit.pending(tasks, log, (audit.SUCCESS, audit.ERROR))


@query("audit_summary", f"{_LOG} SELECT status, count(*) AS tables FROM log GROUP BY status")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.run_summary(fx.AUDIT.frame(spark, sf_dir))
