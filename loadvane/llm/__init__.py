"""Operators of a training-data pipeline: text, tokens and vectors at corpus scale."""
