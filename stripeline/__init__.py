"""A PySpark engine for ORC files declared as SQL tables."""
