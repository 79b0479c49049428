"""Readers: tables, review-API pages, HTML lists, delimited files."""
