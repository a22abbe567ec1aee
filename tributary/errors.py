"""The one error type callers are expected to catch."""


class ExtractError(ValueError):
    """A request, document or table breaks a rule stated in the message."""
