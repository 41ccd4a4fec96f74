"""Operators on the long tables ``bow(doc, label, word, word_count)`` and ``features(doc, label, word_index, value)``."""
