"""Readers of provider formats and writers of products."""
