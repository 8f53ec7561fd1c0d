"""Writers: files, tables, alert payloads, snapshots."""
