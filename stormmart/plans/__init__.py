"""Model layers (stage -> clean -> mart), batch ingestion and the sample jobs."""
