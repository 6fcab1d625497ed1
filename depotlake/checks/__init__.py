"""Every operator as a query over the given tables, and the same query as independent SQL."""
