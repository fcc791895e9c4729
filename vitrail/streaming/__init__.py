"""Streaming: the reference has no streaming workload (no watermarks, windows or state).

Its ingest operator is a chain of stateless column expressions, so :mod:`.ingest` runs the
same parse on ``readStream`` text sources (names given, since a stream has no first
line to peek), with a running malformed-line count; fitted ``PipelineModel``s score
streaming DataFrames unchanged through ``transform``.
"""
