"""Reduce and summarise sensor telemetry with Spark DataFrames.

JSON readings arrive as text, are parsed into typed rows, appended to a raw
table, and folded into one summary row per measure and event-time window.
Every transform is ``DataFrame -> DataFrame`` and works on batch and streaming
input alike.
"""
