"""DataFrame to DataFrame operators, free of I/O."""
