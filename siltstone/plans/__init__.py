"""Table plans: bronze loads, silver tables, the gold report."""
