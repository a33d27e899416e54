"""Training-data operators: scoring, de-duplication, scanning and mixing of document tables.

Nothing else in the library imports this subpackage.
"""
