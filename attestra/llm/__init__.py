"""Operators that prepare training data: documents in, documents or decisions about them out."""
