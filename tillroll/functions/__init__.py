"""Column expressions shared by the operators; none of them leaves the JVM."""
