"""Readers and writers: pages, JSON documents, keyed tables."""
