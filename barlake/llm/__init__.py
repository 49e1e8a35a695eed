"""Operators for preparing training text (see ``registry`` for their queries)."""
