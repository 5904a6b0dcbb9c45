"""Operators that need more than one built-in expression: hashed term
frequencies and TF-IDF as exploded rows, and the ML building blocks."""
