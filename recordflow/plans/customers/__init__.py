"""Customer records: snapshot, merge, change records, extract, reconciliation."""
