"""Incremental planning (which days to process) and the batch jobs."""
