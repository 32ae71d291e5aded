"""Every operator as a query over the given tables, each with the SQL of its expected result."""
