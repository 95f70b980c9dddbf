"""Column expressions: text cleaning, typing, hashing and time arithmetic."""
