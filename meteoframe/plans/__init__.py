"""Named query plans over the driver tables and their DuckDB SQL twins."""
