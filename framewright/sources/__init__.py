"""Readers and writers: annotation tables, manifests, storage keys."""
