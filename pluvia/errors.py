"""Errors the jobs raise on purpose."""


class EmptyInputError(ValueError):
    """A job was asked to work on years that hold no data."""


class QualityError(AssertionError):
    """A quality rule of severity ``error`` found failing rows."""


class LandingError(ValueError):
    """An archive did not land completely."""


class PublishError(RuntimeError):
    """Another job published the same tables in the meantime."""
