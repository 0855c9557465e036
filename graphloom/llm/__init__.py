"""Operators for preparing training text at scale; nothing else in graphloom imports this subpackage."""
