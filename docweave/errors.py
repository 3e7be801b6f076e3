"""Errors with a short code, as clients of the document service read them."""

from __future__ import annotations


class DocumentError(ValueError):
    """A request that can't be carried out: code tells the kind, message the details."""

    def __init__(self, code: str, message: str = "") -> None:
        super().__init__(f"{code}: {message}" if message else code)
        self.code, self.message = code, message


# Codes in use.
INVALID_FIELD = "invalid-field"
INVALID_COMPARISON = "invalid-comparison"
INVALID_QUERY = "invalid-query"
INVALID_VALUE = "invalid-value"
NULL_QUERY = "null-query"
NO_ACCESS = "no-access"
DUPLICATE = "duplicate"
UNKNOWN_ENTITY = "unknown-entity"
UNKNOWN_VERSION = "unknown-version"
INVALID_METADATA = "invalid-metadata"
NO_UPSERT = "insertion-attempt-with-no-upsert"
CONFLICT = "update-conflict"
TOO_LARGE = "result-too-large"
LOCK = "lock-not-held"
