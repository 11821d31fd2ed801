"""Column builders: every function takes and returns Columns and stays inside the JVM."""
