"""Layouts: the physical form of a resource, compiled once from schema and profile and fingerprinted.

A layout is closed: unknown fields, kinds and modes are refused, nothing is inferred from data.  Each logical field has
one Parquet column; fields with full text have two derived columns beside it (tokens, number of tokens) that are filled
when a document is projected, so that queries never tokenise.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from tidemark.engine.analysis import chains_fingerprint
from tidemark.engine.errors import InvalidRequest, Unsupported
from tidemark.engine.values import column_name, fingerprint, language_tag

EXACT, EXISTS, FACET, FULL_TEXT, HIGHLIGHT, PREFIX, RANGE = "exact", "exists", "facet", "full-text", "highlight", "prefix", "range"

#: Logical kind -> (Spark type, modes besides ``exists``).
KINDS: dict[str, tuple[T.DataType, tuple[str, ...]]] = {
    "boolean": (T.BooleanType(), (EXACT,)),
    **{k: (T.LongType(), (EXACT, RANGE)) for k in ("int8", "int16", "int32", "int64", "duration")},
    "float64": (T.DoubleType(), (EXACT, RANGE)),
    "decimal": (T.StringType(), (EXACT,)),
    **{k: (T.StringType(), (EXACT, PREFIX)) for k in ("string", "uuid", "enum")},
    "utcTimestamp": (T.TimestampType(), (EXACT, RANGE)),
    "date": (T.DateType(), (EXACT, RANGE)),
    "bytes": (T.StringType(), ()),
    "wgs84Point": (T.ArrayType(T.DoubleType()), ()),
    "json": (T.StringType(), ()),
    "recordRef": (T.StringType(), ()),
    "objectRef": (T.StringType(), ()),
}
#: Hidden columns of every document.
HIDDEN = T.StructType([
    T.StructField("m_document_id", T.StringType()), T.StructField("m_scope", T.StringType()), T.StructField("m_resource", T.StringType()),
    T.StructField("m_record_id", T.StringType()), T.StructField("m_source_version", T.StringType()), T.StructField("m_source_sequence", T.LongType()),
    T.StructField("m_schema_version", T.StringType()), T.StructField("m_schema_fingerprint", T.StringType()), T.StructField("m_source_digest", T.StringType()),
    T.StructField("m_event_id", T.StringType()), T.StructField("m_projected_at", T.TimestampType()), T.StructField("m_deleted", T.BooleanType()),
])


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    many: bool = False
    precision: int = 18
    scale: int = 0
    language: str | None = None


#: Names under which a field's annotations may give its language.
LANGUAGE_KEYS = ("language", "search.language")


def language_of(annotations: Mapping[str, object]) -> str | None:
    """The language that a field's annotations give; two that differ are refused."""
    given = {annotations[k] for k in LANGUAGE_KEYS if k in annotations}
    if len(given) > 1:
        raise InvalidRequest("the annotations give different languages")
    return language_tag(given.pop()) if given else None


@dataclass(frozen=True)
class Schema:
    resource: str
    fields: tuple[Field, ...]
    identity: tuple[str, ...]
    version: str = "1"

    @property
    def fingerprint(self) -> str:
        return fingerprint({"resource": self.resource, "fields": [asdict(f) for f in self.fields], "identity": list(self.identity), "version": self.version})


@dataclass(frozen=True)
class SearchProfile:
    """Which fields are text, facets and highlights. ``analysis`` "plain" keeps to expressions SQL engines share."""

    sources: tuple[str, ...] = ()
    facets: tuple[str, ...] = ()
    highlights: tuple[str, ...] = ()
    languages: tuple[str, ...] = ("en",)
    ranking: str = "bm25"
    analysis: str = "multilingual"


@dataclass(frozen=True)
class DocumentProfile:
    """A JSON body of which the declared pointers can be filtered."""

    body: str
    pointers: tuple[str, ...] = ()
    facets: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    highlights: tuple[str, ...] = ()
    languages: tuple[str, ...] = ("en",)
    ranking: str = "bm25"
    analysis: str = "multilingual"


@dataclass(frozen=True)
class FieldLayout:
    name: str
    column: str
    kind: str
    many: bool
    modes: tuple[str, ...]
    precision: int = 18
    scale: int = 0
    language: str | None = None
    source: str | None = None
    pointer: str | None = None

    @property
    def element(self) -> T.DataType:
        if self.kind == "decimal" and self.precision <= 18 and self.scale <= 18:
            return T.DecimalType(max(self.precision, self.scale), self.scale)
        return KINDS[self.kind][0]

    @property
    def type(self) -> T.DataType:
        return T.ArrayType(self.element) if self.many else self.element

    @property
    def tokens(self) -> str:
        return f"t_{self.column}"

    @property
    def length(self) -> str:
        return f"n_{self.column}"


@dataclass(frozen=True)
class Layout:
    resource: str
    schema_fingerprint: str
    profile_kind: str
    profile_fingerprint: str
    identity: tuple[str, ...]
    sources: tuple[str, ...]
    facets: tuple[str, ...]
    highlights: tuple[str, ...]
    languages: tuple[str, ...]
    ranking: str
    analysis: str
    body: str | None = None
    fields: dict[str, FieldLayout] = field(default_factory=dict)

    def field(self, name: object, mode: str | None = None) -> FieldLayout:
        """The field, if the layout has it and it can be used that way."""
        found = self.fields.get(name) if isinstance(name, str) else None
        if found is None:
            raise Unsupported("the layout has no such field")
        if mode is not None and mode not in found.modes:
            raise Unsupported(f"the field has no mode {mode}")
        return found

    @property
    def text_fields(self) -> list[FieldLayout]:
        return [f for f in self.fields.values() if FULL_TEXT in f.modes]

    def struct(self) -> T.StructType:
        """The Parquet schema of a generation."""
        columns = list(HIDDEN.fields)
        for f in self.fields.values():
            columns.append(T.StructField(f.column, f.type))
            if FULL_TEXT in f.modes:
                columns += [T.StructField(f.tokens, T.ArrayType(T.StringType())), T.StructField(f.length, T.IntegerType())]
        return T.StructType(columns)

    def to_dict(self) -> dict:
        return {**asdict(self), "format": "tidemark.layout.v1", "fingerprint": self.fingerprint}

    @property
    def fingerprint(self) -> str:
        return fingerprint({**asdict(self), "chains": chains_fingerprint()})

    @classmethod
    def from_dict(cls, value: Mapping) -> Layout:
        """The closed form read back; anything unknown, missing or altered is refused."""
        value = dict(value)
        stated, form = value.pop("fingerprint", None), value.pop("format", None)
        own = {f for f in cls.__dataclass_fields__}
        if form != "tidemark.layout.v1" or set(value) != own:
            raise InvalidRequest("no layout of this format")
        tuples = ("identity", "sources", "facets", "highlights", "languages")
        made = {k: tuple(v) if k in tuples else v for k, v in value.items() if k != "fields"}
        kinds = set(FieldLayout.__dataclass_fields__)
        for name, f in value["fields"].items():
            if set(f) != kinds or f["name"] != name:
                raise InvalidRequest("no field of this format")
        layout = cls(**made, fields={k: FieldLayout(**{**f, "modes": tuple(f["modes"])}) for k, f in value["fields"].items()})
        if stated != layout.fingerprint:
            raise InvalidRequest("the layout's fingerprint does not hold", "physical-fingerprint")
        return layout


def _field(f: Field, profile: SearchProfile | DocumentProfile) -> FieldLayout:
    if f.kind not in KINDS:
        raise Unsupported("unsupported logical kind")
    if f.kind == "wgs84Point" and f.many:
        raise Unsupported("many points in one field are unsupported")
    modes = [EXISTS, *KINDS[f.kind][1]]
    if f.kind == "decimal" and f.precision <= 18 and f.scale <= 18:
        modes.append(RANGE)
    textual = f.kind in ("string", "enum")
    if f.name in profile.sources:
        if not textual or f.many:
            raise InvalidRequest("a text source must be one string or enum")
        modes.append(FULL_TEXT)
    if f.name in profile.facets:
        if f.kind not in ("string", "uuid", "enum") or f.name in profile.sources and f.kind != "enum" and f.kind != "string":
            raise InvalidRequest("a facet must be a text")
        modes.append(FACET)
    if f.name in profile.highlights:
        if f.name not in profile.sources:
            raise InvalidRequest("a highlight must be a text source")
        modes.append(HIGHLIGHT)
    language = language_tag(f.language) if f.language is not None else None
    return FieldLayout(f.name, column_name(f.name), f.kind, f.many, tuple(sorted(modes)), f.precision, f.scale, language)


def compile_layout(schema: Schema, profile: SearchProfile | DocumentProfile | None = None) -> Layout:
    """The layout of a resource, or a typed refusal."""
    profile = profile or SearchProfile()
    catalog, _, rest = schema.resource.partition(":")
    if catalog != "structured" or not all(rest.partition(".")[::2]):
        raise InvalidRequest("a resource is structured:<namespace>.<name>")
    names = [f.name for f in schema.fields]
    if len(set(names)) < len(names) or not names:
        raise InvalidRequest("fields must be present and differ")
    is_document = isinstance(profile, DocumentProfile)
    wanted = [*schema.identity, *profile.sources, *profile.highlights, *([profile.body] if is_document else profile.facets)]
    if not schema.identity or set(wanted) - set(names):
        raise InvalidRequest("identity and profile may name fields of the schema only")
    fields = {f.name: _field(f, profile if not is_document else SearchProfile()) for f in schema.fields}
    if is_document:
        if fields[profile.body].kind != "json":
            raise InvalidRequest("the body of a document must be json")
        for pointer in profile.pointers:
            if not pointer.startswith("/") or any(p.startswith("-") and p[1:].isdigit() for p in pointer.split("/")):
                raise InvalidRequest("a JSON pointer begins with / and counts from the front")
            name = f"{profile.body}#{pointer}"
            modes = tuple(sorted((EXACT, EXISTS, PREFIX, *([FACET] if pointer in profile.facets else []))))
            fields[name] = FieldLayout(name, column_name(profile.body, pointer), "string", False, modes, source=profile.body, pointer=pointer)
    return Layout(
        schema.resource, schema.fingerprint, "document" if is_document else "search", fingerprint(asdict(profile)), tuple(schema.identity),
        () if is_document else tuple(profile.sources), tuple(f"{profile.body}#{p}" for p in profile.facets) if is_document else tuple(profile.facets),
        () if is_document else tuple(profile.highlights), tuple(sorted({language_tag(x) for x in profile.languages})), profile.ranking, profile.analysis,
        profile.body if is_document else None, fields,
    )
