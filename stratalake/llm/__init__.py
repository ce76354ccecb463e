"""Operators that prepare training data for language models. Nothing else imports this package."""
