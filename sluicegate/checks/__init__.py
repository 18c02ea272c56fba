"""Every operator over the given tables, and SQL that computes the same without it."""
