"""Operators that prepare training data: formatting, tokens, near copies, filters, packing."""
