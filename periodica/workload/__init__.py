"""The registered queries: domain views over the given tables, and one entry per operator."""
