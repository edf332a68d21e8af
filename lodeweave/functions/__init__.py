"""Column functions: text, numbers, times, hashes and JSON."""
