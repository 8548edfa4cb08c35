"""Operators for training data: documents, pages and vectors in, decisions out."""
