"""Readers of landed files.

Every ``read_*`` loads text with a declared schema and hands it to a ``parse_*``
function over columns, so the same parsing runs on files, tables and streams.
"""
