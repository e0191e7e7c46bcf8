"""Column expressions; every one of them stays inside the JVM."""
