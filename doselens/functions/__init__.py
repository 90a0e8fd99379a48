"""Column-to-Column cleaning functions. All of them run inside the JVM."""
