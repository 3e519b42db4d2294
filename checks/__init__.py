"""Checking queries in DuckDB SQL, written apart from the Spark plans."""
