"""Training-data operators: licences, URL rules, near-duplicates, language, tokens, quality, mixing, decontamination."""
