"""Sources: bronze JSON, tolerant CSV, dimension tables, test-table adapters."""
