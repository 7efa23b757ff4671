"""Relational operators over row-change logs."""
