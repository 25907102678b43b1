"""Operators for large training-data pipelines (quality, dedup, WARC, HTML, packing ...).

Nothing outside this subpackage imports it; ``queries.py`` registers its queries.
"""
