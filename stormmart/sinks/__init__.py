"""Writers: table creation, idempotent batch appends, load log, upsert, results."""
