"""Operators that prepare text for training language models; nothing outside imports them."""
