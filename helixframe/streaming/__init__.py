"""Incremental use of the batch operators over files that keep arriving."""
