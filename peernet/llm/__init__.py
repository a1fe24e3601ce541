"""Training-data operators: archives, language, packing, search, tokens, near duplicates, fingerprints, licences."""
