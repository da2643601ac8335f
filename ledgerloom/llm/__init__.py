"""Operators for large language model corpora. Nothing outside this subpackage imports it."""
