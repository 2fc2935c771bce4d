"""Stage composites that chain operators and write log tables."""
