"""Writers for stored tables, databases and the alert outbox."""
