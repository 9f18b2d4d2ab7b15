"""Table-in, table-out operators: cleaning, upserts, versions, layout, data tests."""
