"""Acceptance queries over the driver tables, each with DuckDB SQL to check it."""
