"""Operators for building language-model training data; nothing else imports them."""
