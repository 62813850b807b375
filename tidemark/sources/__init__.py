"""Readers: landed files, archives, documents, envelopes, databases, the catalog."""
