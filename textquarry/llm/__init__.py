"""Operators for building training corpora (language, duplicates, leaks,
personal data, mixing, licences, token counts, chat logs).

Nothing else in the library imports this subpackage.
"""
