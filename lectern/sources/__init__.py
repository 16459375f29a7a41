"""Readers for the harvested feeds, and the stored catalog, its indexes and directories."""
