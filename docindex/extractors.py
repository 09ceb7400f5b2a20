"""``bytes -> text`` functions for :func:`docindex.operators.documents.extract_with`."""

from __future__ import annotations


def utf8_text(content: bytes) -> str:
    """Plain text; bytes that are not UTF-8 are an error, hence empty text."""
    return content.decode("utf-8")

