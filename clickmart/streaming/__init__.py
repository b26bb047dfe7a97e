"""Streaming jobs (hourly metrics, scoring) and the replay-safe micro-batch sink."""
