"""Readers and writers: raw word counts, processed CSV, text tables, vector tables."""
