"""Operators over text corpora: filters, joins, encoders, fingerprints, models."""
