"""Error classes of the library."""


class SpectrineError(Exception):
    """Base of all errors raised here."""


class DefinitionError(SpectrineError, ValueError):
    """A pipeline definition breaks a rule of the plan language."""


class DataError(SpectrineError, ValueError):
    """Input rows break the dataset contract."""


class UnsupportedCapability(SpectrineError):
    """A well-formed request that this engine does not execute."""


class SessionClosed(SpectrineError):
    """A session was used after it was closed."""


class ArchiveError(SpectrineError):
    """Base of archive errors; ``code`` names the kind."""

    code = "archive"


class ArchiveFormatError(ArchiveError):
    code = "format"


class ArchiveIntegrityError(ArchiveError):
    code = "integrity"


class ArchiveUnsupported(ArchiveError, UnsupportedCapability):
    code = "unsupported_capability"


class ArchiveExists(ArchiveError):
    code = "already_exists"


class PublishedWithCleanupError(ArchiveError):
    """The archive was published, but its temporary name could not be removed."""

    code = "published_with_cleanup_error"
