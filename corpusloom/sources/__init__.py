"""Readers and writers of ledgers, configurations, archives and landed pages."""
