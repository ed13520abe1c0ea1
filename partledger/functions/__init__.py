"""Column-level functions; everything here stays inside the JVM except the edit-similarity kernel."""
