"""Structured Streaming forms: continuous frame decode and stateful thinning."""
