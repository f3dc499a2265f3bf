"""Importing this module registers every query."""

from neoflow.plans import q_feed, q_flatten, q_offsets, q_stream, q_topics  # noqa: F401
