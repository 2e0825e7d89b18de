"""Column functions: time, identity, numbers and display text."""
