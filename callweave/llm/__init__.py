"""Training-data operators: quality, packing, sharding, toxicity, PII, near-duplicates,
mixing, fixity and decontamination.  Nothing else in the library imports this package."""
