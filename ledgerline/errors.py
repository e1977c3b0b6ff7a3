"""Errors of the library. Row-level faults are data (error columns); these are raised only by ``require`` and by drivers."""


class LedgerlineError(Exception):
    """Base of all."""


class ConfigError(LedgerlineError, ValueError):
    """A configuration entry is missing or wrong; the message names it."""


class NormalisationError(LedgerlineError, ValueError):
    """A cell is not an unambiguous number."""


class BasisError(LedgerlineError, ValueError):
    """An operand stands on another basis than its identity is pinned to."""


class ExtractionError(LedgerlineError):
    """A cell lacks what the cell contract asks for."""


class NoTemplateTableError(LedgerlineError):
    """No table of a document matches the template, or none of its rows could be mapped."""


class StoreError(LedgerlineError, ValueError):
    """A table on disk or a row to be stored breaks the store's schema."""


class RegistryError(LedgerlineError, ValueError):
    """A ledger line is malformed."""


class ReviewError(LedgerlineError, ValueError):
    """A queue line or a resolution is not acceptable."""
