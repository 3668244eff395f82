"""Operators of a training-data pipeline: mixing, decontamination, licences, dedup, tokens.

Nothing outside this subpackage imports it; the entry module adds its queries only when
the subpackage is present.
"""
