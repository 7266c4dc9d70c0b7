"""Operators of a training-data pipeline: each module holds one operator and its `query`."""
