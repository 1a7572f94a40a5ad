"""Preparation of text corpora for training: cleaning, near-copies, mixing, tokens."""
