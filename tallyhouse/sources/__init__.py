"""Readers: register payloads, landing tables, the star-schema adapter."""
