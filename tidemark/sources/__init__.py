"""Sources: driver tables, named sources, schema-version unions."""
