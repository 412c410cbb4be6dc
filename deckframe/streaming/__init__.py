"""Structured Streaming ingest: landing folder -> keyed state, one upsert per micro-batch."""

from deckframe.streaming.ingest import (landing_stream, latest_state, latest_state_batch,
                                        run_upsert_stream)

__all__ = ["landing_stream", "latest_state", "latest_state_batch", "run_upsert_stream"]
