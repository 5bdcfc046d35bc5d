"""Table-level building blocks: joins, exact ntile, duplicate removal, upsert."""
