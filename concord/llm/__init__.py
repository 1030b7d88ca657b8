"""Operators of a training-data pipeline: deduplication, filtering, scanning, mixing and chat formatting.

Nothing outside this subpackage imports it.
"""
