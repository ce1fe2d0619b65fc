"""Errors a caller can tell apart."""


class SieveError(Exception):
    """Base of every error raised here."""


class SourceError(SieveError):
    """A source could not be read; the next source may be tried."""


class SourceUnavailable(SourceError):
    """One source, or every source in a list, is out of reach."""


class EmptySource(SieveError):
    """A source answered with nothing. Not a SourceError: it stops the search."""


class TransformError(SieveError):
    """Loading, cleaning or shaping failed."""


class AlignmentError(TransformError):
    """Duplicate keys, or times off the grid."""


class BoundsError(TransformError):
    """Irradiance outside its physical range."""


class LoadError(SieveError):
    """A batch could not be added to the table."""


class QueryError(SieveError):
    """A query was refused or failed."""
