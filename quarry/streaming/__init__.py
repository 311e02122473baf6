"""Structured Streaming form of the word count (the only operator here whose
input naturally arrives as files over time)."""

from quarry.streaming.wordcount import read_word_counts, start_word_count, start_word_count_to_table, word_count_stream

__all__ = ["read_word_counts", "start_word_count", "start_word_count_to_table", "word_count_stream"]
