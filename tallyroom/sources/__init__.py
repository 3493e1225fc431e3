"""Readers, the catalog, and the mapping from a wholesale star schema to the retail tables."""
