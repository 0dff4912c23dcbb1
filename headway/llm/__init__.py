"""Operators of a training-data pipeline: scans, tokenisation, near duplicates, scoring, packing.

Nothing outside this package imports it; ``headway.llm.queries`` registers its queries.
"""
