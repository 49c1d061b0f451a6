"""Operators on text corpora for language models: token ids, packing, sentence units."""
