"""Readers and writers for the file formats of a training corpus."""
