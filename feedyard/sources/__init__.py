"""Readers: directory listings, delimited files, archives and configuration CSVs."""
