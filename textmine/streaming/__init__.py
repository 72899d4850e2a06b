"""The stateless operators applied to streaming sources."""

from textmine.streaming.words import document_stream, run_available, stream_word_counts

__all__ = ["document_stream", "run_available", "stream_word_counts"]
