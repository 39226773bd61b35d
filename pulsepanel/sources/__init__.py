"""Readers of landed source files: one ``read_*`` per file, one ``*_panel`` per table.

Readers keep every field as text and pick columns by header name; the panel functions convert.
That keeps codes such as "01" intact and lets the same conversion run on any text table.
"""
