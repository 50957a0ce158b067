"""Snapshots, landing directories, curated tables, the file ledger."""
