"""Scans: text files, table columns split into lines, side-input files."""
