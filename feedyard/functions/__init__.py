"""Column expressions: paths, fingerprints, filename metadata, requests, masking."""
