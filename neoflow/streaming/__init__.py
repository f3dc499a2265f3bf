"""Structured Streaming jobs."""

from neoflow.streaming.jobs import (landing_stream, run_available_now, run_until_caught_up,
                                    topic_to_parquet)

__all__ = ["landing_stream", "run_available_now", "run_until_caught_up", "topic_to_parquet"]
