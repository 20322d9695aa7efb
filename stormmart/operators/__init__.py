"""DataFrame -> DataFrame operators (cleaning, dedupe, upsert, quality, lookups)."""
