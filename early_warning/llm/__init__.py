"""Operators on training-data text. Nothing outside this subpackage imports it but the entry file."""
