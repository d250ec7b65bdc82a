"""Operators: classification, checksum, decoding, thinning, state, reshape, packs, reports."""
