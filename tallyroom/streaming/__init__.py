"""Incremental loading, in batches and as a file stream."""
