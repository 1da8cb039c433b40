"""Failure categories a caller may want to handle separately."""


class SyncError(Exception):
    """Base class of every error raised by this package."""


class ContractError(SyncError, ValueError):
    """A table, row or mark does not satisfy its declared contract."""


class CheckpointCorrupt(SyncError):
    """Stored state exists but cannot be understood."""


class RunInProgress(SyncError):
    """Another run holds the claim on the next commit."""


class CommitInterrupted(SyncError):
    """A run cannot be committed, or a half-committed one cannot be finished."""


class SourceError(SyncError):
    """The source could not be read."""


class IncompatibleSchema(SyncError):
    """The source schema broke a consumer's contract."""
