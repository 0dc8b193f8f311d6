"""The driver's view: queries over its tables, and the same in DuckDB SQL."""
