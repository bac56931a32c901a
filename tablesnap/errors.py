"""Errors a caller may want to tell apart."""


class SnapshotMissing(LookupError):
    """An offline read of a table that has no snapshot."""


class SchemaChanged(RuntimeError):
    """A refresh changed the columns the caller was bound to; rerun against the new ones."""


class WrongCall(ValueError):
    """A function of the store is called in SQL with arguments that it does not take."""
