"""Readers and writers: JSON topics and dimension tables."""
