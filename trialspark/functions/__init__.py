"""Column functions: dates, lists, hashes, text, vectors and geography."""
