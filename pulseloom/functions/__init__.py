"""Shared building blocks: exact quantiles, global ranks, hash sampling, text and time expressions."""
