"""Settings from a closed mapping; the secret never comes from it and is never shown."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

from tidemark.engine.cursor import KeyRing
from tidemark.engine.errors import ConfigurationError
from tidemark.engine.limits import CURSOR_SECONDS, LEASE_SECONDS, Limits
from tidemark.engine.session import Session
from tidemark.engine.values import is_fingerprint, prefix_name

_LIMITS = {f.name for f in fields(Limits)}


@dataclass(frozen=True)
class Settings:
    root: str
    prefix: str
    buckets: int = 16
    point_in_time: bool = False
    result_bytes: int | None = None
    cursor_seconds: int = CURSOR_SECONDS
    lease_seconds: int = LEASE_SECONDS
    pin: str | None = None
    limits: Limits = field(default_factory=Limits)

    @classmethod
    def from_mapping(cls, given: object) -> Settings:
        """Exactly the keys above; limits by their names. Anything else is refused, without repeating its value."""
        if not isinstance(given, Mapping) or set(given) - {f.name for f in fields(cls)} or {"root", "prefix"} - set(given):
            raise ConfigurationError("settings have unknown or missing keys")
        limits = given.get("limits", {})
        if not isinstance(limits, Mapping) or set(limits) - _LIMITS:
            raise ConfigurationError("limits have unknown keys")
        made = cls(**{**given, "limits": Limits(**limits)})
        for name, kind, low, high in (("buckets", int, 1, 65_536), ("result_bytes", int | None, 1, 1 << 31), ("cursor_seconds", int, 30, 86_400), ("lease_seconds", int, 1, 86_400)):
            value = getattr(made, name)
            if isinstance(value, bool) or not isinstance(value, kind) or (value is not None and not low <= value <= high):
                raise ConfigurationError(f"{name} is out of bounds")
        if not isinstance(made.point_in_time, bool) or not isinstance(made.root, str) or not made.root:
            raise ConfigurationError("a setting has another type")
        if made.pin is not None and not is_fingerprint(made.pin):
            raise ConfigurationError("the pin is no fingerprint")
        try:
            prefix_name(made.prefix)
        except ValueError:
            raise ConfigurationError("the prefix is unusable") from None
        return made

    def session(self, spark: SparkSession, secret: bytes | KeyRing) -> Session:
        return Session(
            spark, self.root, self.prefix, secret, self.limits, self.point_in_time, self.result_bytes, cursor_seconds=self.cursor_seconds,
            lease_seconds=self.lease_seconds, pin=self.pin,
        )
