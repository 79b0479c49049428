"""Writers: files, keyed tables, exports."""
