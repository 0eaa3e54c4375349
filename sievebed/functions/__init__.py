"""Column expressions.  All run inside the JVM but for the decoding of HTML entities in short texts."""
