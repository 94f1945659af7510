"""Training-data operators: formatting, dedup, quality, language, secrets, mixing, PII, tokens, decontamination.

Nothing outside this package imports it.  Every operator reads DataFrames and
returns DataFrames; the thin ``opN_*`` queries live in ``kymo.llm.queries``.
"""
