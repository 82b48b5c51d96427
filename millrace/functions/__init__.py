"""Column-level functions: every one maps columns to a column, JVM-side."""
