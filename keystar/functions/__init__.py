"""Column -> Column helpers; every one stays inside the JVM."""
