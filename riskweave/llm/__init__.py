"""Operators of a training-data pipeline: labelling, filtering, joining, mixing, sharding and encoding of texts."""
