"""Incremental writers and the row selections they are made of."""
