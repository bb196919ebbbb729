"""Readers for logs, warehouse tables and message streams."""
