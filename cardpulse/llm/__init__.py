"""Training-data operators: search, quality, fingerprints, PII, token files,
toxicity, packing, mixing, near duplicates and language."""
