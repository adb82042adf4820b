"""Readers: pages of HTML, feeds of boards in JSON, RSS, sitemaps, and stored tables."""
