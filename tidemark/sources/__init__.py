"""Landed-document sources, stored tables and watermark state."""
