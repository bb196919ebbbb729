"""Every job as a query over the sample tables, and the same in ANSI SQL."""
