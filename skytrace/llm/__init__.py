"""Training-data operators: near-duplicates, fingerprints, repeats, URL rules, quality,
language-model scores, decontamination, personal data, token files and SentencePiece."""
