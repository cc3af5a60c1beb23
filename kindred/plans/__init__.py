"""Registered queries over the driver tables and their SQL twins."""
