"""Readers, writers and adapters that produce the canonical raw ledger."""
