"""Operators for training data: thirteen ways to clean, judge, search and pack a corpus. Nothing else imports them."""
