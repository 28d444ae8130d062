"""Landed JSON responses in, warehouse tables in and out."""
