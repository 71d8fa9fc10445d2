"""Operators for preparing language-model training data (documents in,
documents, scores, classes or token files out).  Nothing outside this
subpackage imports it."""
