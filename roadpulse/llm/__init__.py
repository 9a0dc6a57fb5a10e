"""Operators for large training corpora. Nothing outside imports this subpackage."""
