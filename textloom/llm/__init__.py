"""Operators for preparing training text: copies, repeated passages, leaks, mixing, secrets, chat turns, quality, toxicity."""
