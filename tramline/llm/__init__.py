"""Training-data operators: language-model scoring, media, near-duplicates, token files, mixing, search, toxicity, BPE.

Nothing else in the library imports this subpackage.
"""
