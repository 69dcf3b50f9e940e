"""Column expressions: text cleaning, ids and dates. All of them run in the JVM."""
