"""Relational operators of the reports, as DataFrame transforms."""
