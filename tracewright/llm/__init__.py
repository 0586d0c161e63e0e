"""Training-data operators: tokenising, extraction, deduplication, archives,
privacy, licences, quality, language, near-duplicates and packing."""
