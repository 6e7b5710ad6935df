"""Signed keyset cursors, and the predicate that continues behind a row."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.engine.errors import ConfigurationError, CursorRejected

PREFIX = "tm2"
#: A ring of keys has at most so many: the one that signs, and older ones whose cursors may still be open.
MOST_KEYS = 8


@dataclass(frozen=True)
class KeyRing:
    """Signing keys by their names, of which one signs and all are accepted: keys change without breaking open cursors."""

    active: str
    keys: Mapping[str, bytes] = field(repr=False)

    def __post_init__(self) -> None:
        named = all(isinstance(n, str) and re.fullmatch(r"[A-Za-z0-9_-]{1,64}", n) for n in self.keys)
        if not named or self.active not in self.keys or len(self.keys) > MOST_KEYS:
            raise ConfigurationError("the ring needs its signing key and eight named keys at most")
        if not all(isinstance(k, bytes) and 16 <= len(k) <= 1_024 for k in self.keys.values()):
            raise ConfigurationError("a key has 16 to 1,024 bytes")


class Signer:
    """Tokens that bind a position to its plan, registry, schema, scope and page size, for a while."""

    def __init__(self, keys: KeyRing | bytes, seconds: int, clock: Callable[[], float] = time.time):
        ring = keys if isinstance(keys, KeyRing) else KeyRing("only", {"only": keys})
        self._keys = {n: hmac.new(k, b"tidemark cursor", hashlib.sha256).digest() for n, k in ring.keys.items()}
        self.active, self.seconds, self.clock = ring.active, seconds, clock

    def _sign(self, name: str, body: bytes) -> bytes:
        return hmac.new(self._keys[name], name.encode() + b"." + body, hashlib.sha256).digest()

    def issue(self, bound: dict, after: Sequence, snapshot: str | None = None) -> str:
        body = json.dumps({"b": bound, "a": list(after), "s": snapshot, "e": int(self.clock()) + self.seconds}, sort_keys=True, separators=(",", ":")).encode()
        return f"{PREFIX}.{self.active}." + base64.urlsafe_b64encode(self._sign(self.active, body) + body).decode().rstrip("=")

    def open(self, token: str, bound: dict) -> tuple[list, str | None]:
        """(position, snapshot), or a refusal that does not say which check failed."""
        try:
            prefix, name, rest = token.split(".")
            if prefix != PREFIX or name not in self._keys:
                raise ValueError
            raw = base64.urlsafe_b64decode(rest + "=" * (-len(rest) % 4))
            signature, body = raw[:32], raw[32:]
            if not hmac.compare_digest(signature, self._sign(name, body)):
                raise ValueError
            value = json.loads(body)
            if value["b"] != bound or value["e"] < self.clock():
                raise ValueError
            return value["a"], value["s"]
        except (ValueError, KeyError, TypeError, AttributeError):
            raise CursorRejected("the cursor does not continue this search") from None


def behind(key: Column, value: Column | None, descending: bool, nulls_first: bool) -> Column:
    """Rows strictly behind a value in one key's order; ``value`` None stands for null."""
    if value is None:
        return key.isNotNull() if nulls_first else F.lit(False)
    later = key < value if descending else key > value
    return later if nulls_first else later | key.isNull()


def after(keys: Sequence[tuple[Column, bool, bool]], values: Sequence[Column | None]) -> Column:
    """Rows behind a tuple: behind in the first key, or equal there and behind in the next."""
    out: Column | None = None
    for (key, descending, nulls_first), value in reversed(list(zip(keys, values))):
        step = behind(key, value, descending, nulls_first)
        equal = key.isNull() if value is None else key.eqNullSafe(value)
        out = step if out is None else step | (equal & out)
    return out if out is not None else F.lit(True)
