"""Readers and writers of the text forms and of the stored index."""
