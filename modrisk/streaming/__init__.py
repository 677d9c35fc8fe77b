"""Incremental use of the stateless operators."""
