"""Operators that prepare training text: counting, cleaning, matching and mixing documents."""
