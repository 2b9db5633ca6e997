"""Session settings: named argument first, then the session's value, then the default."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

PREFIX = "docsearch."
#: Each setting's kind and default.
DEFAULTS: dict[str, tuple[type, Any]] = {
    "verify_ssl": (bool, True),
    "timeout": (int, 30000),
    "max_retries": (int, 3),
    "retry_interval": (int, 100),
    "retry_backoff_factor": (float, 2.0),
    "sample_size": (int, 100),
    "batch_size": (int, 1000),
    "batch_size_threshold_factor": (int, 5),
    "scroll_time": (str, "5m"),
}


def _as(kind: type, value: Any) -> Any:
    if kind is bool and isinstance(value, str):
        if value.lower() not in ("true", "false"):
            raise ValueError(f"not a boolean: {value!r}")
        return value.lower() == "true"
    return kind(value)


def setting(spark: SparkSession, name: str, argument: Any = None) -> Any:
    kind, default = DEFAULTS[name]
    value = argument if argument is not None else spark.conf.get(PREFIX + name, None)
    return default if value is None else _as(kind, value)


def current_settings(spark: SparkSession) -> dict[str, Any]:
    return {k: setting(spark, k) for k in DEFAULTS}
