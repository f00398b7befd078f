"""Training-data operators: dedup, decontamination, scoring, redaction, mixing and web archives.

Nothing outside this subpackage imports it; its queries are in :mod:`lexquarry.llm.queries`.
"""
