"""Training-data operators: dedup, language, toxicity, PII, tokens and packing.

Nothing else in the library imports this package; the driver entry point adds
its queries only when it can be imported.
"""
