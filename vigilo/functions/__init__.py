"""Column expressions: school years, recodes, bands, hashes."""
