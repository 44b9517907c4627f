"""Operators on natural-language texts; nothing else in the library imports this subpackage."""
