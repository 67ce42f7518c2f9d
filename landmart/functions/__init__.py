"""Column expressions; nothing here reads, writes or shuffles."""
