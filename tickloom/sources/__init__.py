"""Readers and decoders that produce the canonical trade table."""
