"""Training-data operators: fingerprints, near-duplicates, language, packing and mixing.

Nothing outside this subpackage imports it; ``kinmatch.llm.queries`` registers
its queries.
"""
