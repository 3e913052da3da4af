"""Operators for preparing training corpora: classifiers, deduplication, mixing, joins, encoding."""
