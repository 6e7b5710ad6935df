"""Values, names and fingerprints that must come out the same everywhere, bit by bit."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
from collections.abc import Mapping, Sequence
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from uuid import UUID

_MAX_INT64 = 2**63 - 1


def plain(value: object) -> object:
    """A logical value as JSON: texts, numbers, booleans, null, lists and objects with sorted members."""
    match value:
        case None | bool() | int() | str():
            return value
        case float():
            if math.isfinite(value):
                return value
            raise ValueError("numbers must be finite")
        case Decimal():
            if value.is_finite():
                return f"{value:f}"
            raise ValueError("numbers must be finite")
        case datetime():
            if value.utcoffset() is None:
                raise ValueError("a time needs a time zone")
            return value.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        case date():
            return value.isoformat()
        case timedelta():
            return value // timedelta(microseconds=1)
        case UUID():
            return str(value)
        case bytes() | bytearray() | memoryview():
            return base64.urlsafe_b64encode(bytes(value)).decode().rstrip("=")
        case Mapping():
            if not all(isinstance(k, str) for k in value):
                raise TypeError("names must be texts")
            return {k: plain(value[k]) for k in sorted(value)}
        case Sequence():
            return [plain(v) for v in value]
    raise TypeError(f"no logical value: {type(value).__name__}")


def canonical(value: object) -> str:
    """Compact JSON with sorted members."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def fingerprint(value: object) -> str:
    return "sha256:" + hashlib.sha256(canonical(value).encode()).hexdigest()


def is_fingerprint(value: object) -> bool:
    return isinstance(value, str) and re.fullmatch(r"sha256:[0-9a-f]{64}", value) is not None


def checked_fingerprint(value: object) -> str:
    if not is_fingerprint(value):
        raise ValueError("no sha256 fingerprint")
    return value  # type: ignore[return-value]


def token(value: object, most: int = 256) -> str:
    """A text that is not empty, not longer than so many bytes and without control characters."""
    if isinstance(value, str) and 0 < len(value.encode()) <= most and not re.search(r"[\x00-\x1f\x7f]", value):
        return value
    raise ValueError("a bounded text without control characters is needed")


def record_identity(value: object) -> str:
    """The canonical text of an identity: a scalar, or a list of scalars that is not empty."""
    value = plain(value)
    parts = value if isinstance(value, list) else [value]
    if not parts or any(p is None or isinstance(p, list | dict) for p in parts):
        raise ValueError("an identity is a scalar or a list of scalars")
    return canonical(value)


def document_id(scope: str, resource: str, identity: object) -> str:
    body = {"recordId": json.loads(record_identity(identity)), "resource": resource, "scope": checked_fingerprint(scope)}
    return hashlib.sha256(canonical(body).encode()).hexdigest()


def scope_fingerprint(tenant: str | None, scope: Mapping[str, str] | None = None) -> str:
    scope = scope or {}
    if tenant is None and not scope:
        raise ValueError("a tenant or a scope is needed")
    return fingerprint({"scope": {token(k, 64): token(v) for k, v in scope.items()}, "tenant": None if tenant is None else token(tenant)})


#: The forms of names below are the engine's own; nothing outside reads them.
def _short(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def column_name(field: str, pointer: str | None = None) -> str:
    """The physical name of a field, or of a JSON path within it."""
    return f"f_{_short(field)}" if pointer is None else f"p_{_short(field + chr(0) + pointer)}"


def prefix_name(text: object) -> str:
    name = re.sub(r"[^a-z0-9_-]+", "-", token(text, 128).casefold()).strip("-_")[:80]
    if not name:
        raise ValueError("a prefix needs a letter or digit")
    return name


def generation_name(prefix: str, resource: str, number: int) -> str:
    if isinstance(number, bool) or not isinstance(number, int) or not 0 < number < 1_000_000:
        raise ValueError("generations are numbered from 1 to 999999")
    return f"{prefix_name(prefix)}-i-{_short(resource)}-g{number:06d}"


def resource_folder(prefix: str, resource: str) -> str:
    return f"{prefix_name(prefix)}/{_short(resource)}"


def language_tag(text: object) -> str:
    if isinstance(text, str) and re.fullmatch(r"[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*", text):
        return text.lower()
    raise ValueError("no BCP 47 language tag")


def is_sequence_number(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and 1 <= value <= _MAX_INT64
