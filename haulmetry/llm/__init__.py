"""Operators of a training-data pipeline: rules, deduplication, decontamination, mixing, scoring and output."""
