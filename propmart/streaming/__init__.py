"""Incremental (file-stream) form of the landing job."""
