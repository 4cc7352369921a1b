"""Folders of the given tables (a module of its own: test folders have several conftest files)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"
