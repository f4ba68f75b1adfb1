"""Column expressions: everything here maps Columns to a Column and stays on the JVM."""
