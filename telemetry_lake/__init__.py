"""Telemetry lakehouse analytics on Spark: streams in, layered tables, KPIs, alerts, marts, risk model."""
