"""Operators of a training-data pipeline (search, tokenising, filtering,
extraction, scoring, deduplication, packing), each by one stated method.

Nothing outside this subpackage imports it."""
