"""Readers and writers for articles, histories and word lists."""
