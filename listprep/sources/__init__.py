"""Readers for the supported list, page, snapshot and progress formats."""
