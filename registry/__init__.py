"""The analyses run on the order-processing test tables, with the SQL each result must equal."""
