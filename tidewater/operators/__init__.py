"""Batch operators; most of them work on streams as well."""
