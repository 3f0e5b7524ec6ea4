"""Column expressions: text, scores and contract rules. All of them stay in the JVM."""
