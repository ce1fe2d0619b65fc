"""Operators for training data, their queries and their SQL; nothing outside imports them."""
