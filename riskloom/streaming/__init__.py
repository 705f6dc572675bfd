"""Structured Streaming: the micro-batch scorer, the keyed-state scorers and the file runner."""

from .scorer import stream_context, stream_scores, stream_window_scores  # noqa: F401
from .batches import BatchScorer  # noqa: F401
