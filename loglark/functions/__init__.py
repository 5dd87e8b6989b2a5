"""Column-level functions: parsing, dates, names, host text."""
