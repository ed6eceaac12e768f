"""Operators of a training-data pipeline (deduplication, sharding,
decontamination, tokenising, classification). Nothing outside this
subpackage imports it."""
