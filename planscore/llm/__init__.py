"""Training-data pipeline operators (language id, revisits, fingerprints, toxicity, secrets,
mixing, subword encoding, line / near / exact dedup). Nothing outside this package imports it."""
