"""Operators for preparing training corpora: mixing, fingerprints, token counts, near-dedup,
toxicity, exact search, packing, language-model scoring, personal data and line dedup.

Nothing else in the library imports this subpackage.
"""
