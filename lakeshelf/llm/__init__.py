"""Operators for training corpora: near and exact duplicates, search, packing, languages, quality,
mixing, license and secret scans. Nothing else in the library imports this subpackage."""
