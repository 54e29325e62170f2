"""Scalar building blocks: Column expressions where Spark has them, batch functions elsewhere."""
