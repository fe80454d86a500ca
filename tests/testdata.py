"""Folders of the given test tables."""

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"
