"""Column builders and SQL measures; all of them stay in the JVM."""
