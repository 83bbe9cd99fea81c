"""Writers: lake tables, raw landing, rejects, serving cells, topics."""
