"""Typed errors. Messages name the rule that was broken, never paths, literals or credentials."""

from __future__ import annotations


class EngineError(Exception):
    """``code`` says what went wrong, ``retryable`` whether the same call may succeed later."""

    code = "internal"
    retryable = False

    def __init__(self, message: str = "", code: str | None = None):
        super().__init__(message)
        if code:
            self.code = code


class InvalidRequest(EngineError):
    code = "operation-invalid"


class ScopeViolation(InvalidRequest):
    code = "operation-scope"


class LimitExceeded(InvalidRequest):
    code = "result-limit"


class Unsupported(InvalidRequest):
    code = "capability-unsupported"


class FingerprintDrift(InvalidRequest):
    code = "physical-fingerprint"


class Unplaced(InvalidRequest):
    code = "placement-unresolved"


class CursorRejected(InvalidRequest):
    code = "cursor-invalid"


class ConfigurationError(EngineError):
    code = "configuration"


class LifecycleError(EngineError):
    code = "lifecycle"


class NotFound(EngineError):
    code = "not-found"


class Conflict(EngineError):
    code = "version-conflict"


class Incompatible(EngineError):
    code = "incompatible-version"


class FeatureMissing(EngineError):
    code = "required-feature"


class MappingConflict(EngineError):
    code = "mapping-conflict"


class Transient(EngineError):
    code = "unavailable"
    retryable = True


class Rejected(Transient):
    """Another writer was faster; nothing was applied."""

    code = "bulk-rejected"


#: Spark's and the file system's conditions, by what callers can do about them.
_CLASSES = (
    ("FileAlreadyExists", Conflict), ("PublishConflict", Rejected), ("FileNotFound", NotFound), ("PATH_NOT_FOUND", NotFound),
    ("AccessControl", type("Forbidden", (EngineError,), {"code": "authorization"})), ("CAST_INVALID_INPUT", MappingConflict),
    ("DATATYPE_MISMATCH", MappingConflict), ("OutOfMemory", Transient), ("SparkContext was shut down", Transient), ("Timeout", Transient),
)


def translate(error: BaseException) -> EngineError:
    """The typed, redacted form of an engine failure: only the class name survives."""
    if isinstance(error, EngineError):
        return error
    condition = getattr(error, "getCondition", lambda: None)() or ""
    text = f"{type(error).__name__} {condition} {str(error)[:4000]}"
    kind = next((k for mark, k in _CLASSES if mark in text), EngineError)
    return kind(f"{type(error).__name__}{' ' + condition if condition else ''}")
