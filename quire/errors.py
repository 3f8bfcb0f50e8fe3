"""One exception class per stage."""


class QuireError(Exception):
    """Base of all errors that the engine raises itself."""


class ConfigError(QuireError):
    """A book, chapter or setting that is not configured."""


class SplitError(QuireError):
    """A chapter that the outline does not resolve."""


class ExtractError(QuireError):
    """An extraction that lacks artifacts or pages."""


class BlockError(QuireError):
    """A page or block that breaks the block model; raised by Spark when the row is evaluated, with this name in its message."""


class PatchError(QuireError):
    """An outline rule that does not apply."""


class AlignError(QuireError):
    """Two extractions that do not belong together."""


class ReportError(QuireError):
    """A report that breaks its schema."""
