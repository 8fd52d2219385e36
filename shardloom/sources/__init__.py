"""Readers and writers (files, tables, shards, manifests)."""
