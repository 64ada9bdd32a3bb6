"""Layout-aware document analytics as Spark DataFrame operations."""
