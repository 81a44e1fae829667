"""Operators composed into whole workflows, and the registered queries."""
