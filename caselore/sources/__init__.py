"""Readers, writers and the mapping of the sample tables onto the support-case model."""
