"""Readers and writers: corpora, reviews, QA sets, predictions, metrics."""
