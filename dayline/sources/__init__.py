"""Readers of landed payloads and writers of stage tables.

Fetching is landed first: every reader takes a table
``(source_name, source_url, fetched_at, status, content_type, body)``.
"""
