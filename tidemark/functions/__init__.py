"""Column rules: payload text, clocks, hashes, message headers."""
