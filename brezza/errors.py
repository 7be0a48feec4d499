"""What can go wrong, told apart by where."""


class BrezzaError(Exception):
    """Any error of the engine."""


class ConfigError(BrezzaError, ValueError):
    """A setting or window makes no sense."""


class SourceError(BrezzaError):
    """A source could not be read."""


class TransportError(SourceError):
    """A source did not answer; ``status`` is the HTTP status if there was one."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status

    @property
    def retryable(self) -> bool:
        return self.status is None or self.status == 429 or self.status >= 500


class FormatError(SourceError, ValueError):
    """A source answered something unexpected."""


class SinkError(BrezzaError):
    """A dataset could not be written."""


class SchemaError(SinkError, ValueError):
    """Stored data have other columns or types than expected."""


class MissingMartError(BrezzaError, LookupError):
    """A mart has not been built yet."""


class ExportTooLargeError(BrezzaError, ValueError):
    """An export file would exceed its limit."""
