"""Telemetry-shaped inputs, registered queries and their SQL counterparts."""
