"""Structured Streaming forms of the operators: table replay, watermarks,
windowed aggregates in append mode, stream-stream joins, and
``transformWithState`` processors for timers and per-key state."""
