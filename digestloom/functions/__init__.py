"""Column expressions over digests, feed lines and names."""
