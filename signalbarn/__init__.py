"""Telemetry analytics on Spark: traces, logs and metrics as tables and streams."""

from signalbarn.session import configure, local_session

__all__ = ["configure", "local_session"]
