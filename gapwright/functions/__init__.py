"""Column expressions: row-local scalars and aggregate builders."""
