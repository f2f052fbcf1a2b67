"""Operators of a training-data pipeline (deduplication, decontamination, scans, tokens).

Nothing else in the library imports this subpackage.
"""
