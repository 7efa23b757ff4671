"""Scans: row-change logs, change lines, catalogs, event stores."""
