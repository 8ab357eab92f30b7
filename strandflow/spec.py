"""Mapping specifications: one source table to one destination index, read from TOML, checked before anything runs.

Checks gather every problem of a specification and report them together.
"""

from __future__ import annotations

import ipaddress
import os
import tomllib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from urllib.parse import parse_qs, urlsplit

#: Environment variables that override the file; with the suffix _FILE they name a file that holds the value.
SOURCE_URL_ENV, SEARCH_KEY_ENV = "STRANDFLOW_SOURCE_URL", "STRANDFLOW_SEARCH_API_KEY"


class SpecError(ValueError):
    """A specification that can't be run; the message lists every problem."""


@dataclass(frozen=True)
class SourceSpec:
    url: str = ""
    server_id: int = 0
    allow_insecure: bool = False

    @property
    def database(self) -> str | None:
        return urlsplit(self.url).path.strip("/") or None


@dataclass(frozen=True)
class SearchSpec:
    host: str = ""
    api_key: str | None = field(default=None, repr=False)
    allow_insecure: bool = False
    batch_size: int = 1000
    max_in_flight_tasks: int = 8
    task_poll_ms: int = 100
    task_timeout_secs: int = 300


@dataclass(frozen=True)
class RuntimeSpec:
    state_path: str = "strandflow-state.json"
    snapshot_on_start: bool = True
    flush_interval_ms: int = 1000
    checkpoint_every_events: int = 1000


@dataclass(frozen=True)
class TableSpec:
    table: str
    index: str
    primary_key: str
    fields: tuple[str, ...]
    database: str | None = None
    watch_fields: tuple[str, ...] = ()
    field_aliases: Mapping[str, str] = field(default_factory=dict)
    where_clause: str | None = None
    snapshot_batch_size: int = 10_000
    displayed_attributes: tuple[str, ...] | None = None
    searchable_attributes: tuple[str, ...] | None = None
    filterable_attributes: tuple[str, ...] | None = None
    sortable_attributes: tuple[str, ...] | None = None
    ranking_rules: tuple[str, ...] | None = None
    distinct_attribute: str | None = None

    def target(self, source_field: str) -> str:
        return self.field_aliases.get(source_field, source_field)

    @property
    def document_fields(self) -> tuple[str, ...]:
        return tuple(self.target(f) for f in self.fields)

    @property
    def target_key(self) -> str:
        """The key under its name in the document: an aliased key would not be found by its source name."""
        return self.target(self.primary_key)

    @property
    def settings(self) -> dict[str, object]:
        """Index settings: displayed attributes default to all document fields, others appear only if they are set."""
        named = {n: getattr(self, n) for n in ("searchable_attributes", "filterable_attributes", "sortable_attributes", "ranking_rules", "distinct_attribute")}
        shown = {"displayed_attributes": self.displayed_attributes or self.document_fields}
        return shown | {n: v for n, v in named.items() if v is not None}

    def problems(self) -> list[str]:
        at = f"table {self.table!r}"
        out = [f"{at}: {n} is required" for n in ("table", "index", "primary_key") if not getattr(self, n).strip()]
        if not self.fields:
            out.append(f"{at}: fields is empty")
        if self.primary_key not in self.fields:
            out.append(f"{at}: primary key {self.primary_key!r} is not among its fields")
        if self.snapshot_batch_size <= 0:
            out.append(f"{at}: snapshot_batch_size must be positive")
        out += [f"{at}: a name in {n} is blank" for n in ("fields", "watch_fields") if any(not x.strip() for x in getattr(self, n))]
        out += [f"{at}: field {x!r} is listed twice" for x in _repeated(self.fields)]
        out += [f"{at}: two fields become {x!r}" for x in _repeated(self.document_fields) if x not in _repeated(self.fields)]
        known = {"*", *self.document_fields}
        for name in ("displayed_attributes", "searchable_attributes", "filterable_attributes", "sortable_attributes"):
            values = getattr(self, name) or ()
            out += [f"{at}: a value in {name} is blank" for x in values if not x.strip()]
            out += [f"{at}: {x!r} is twice in {name}" for x in _repeated(values)]
            out += [f"{at}: {x!r} in {name} is no document field" for x in values if x.strip() and x not in known]
        if any(not x.strip() for x in self.ranking_rules or ()):
            out.append(f"{at}: a value in ranking_rules is blank")
        if self.distinct_attribute is not None and self.distinct_attribute not in known:
            out.append(f"{at}: {self.distinct_attribute!r} in distinct_attribute is no document field")
        return out

    def missing_columns(self, columns: Iterable[str]) -> list[str]:
        have = set(columns)
        return [c for c in dict.fromkeys((*self.fields, *self.watch_fields, self.primary_key)) if c not in have]


@dataclass(frozen=True)
class PipelineSpec:
    source: SourceSpec
    search: SearchSpec
    runtime: RuntimeSpec
    tables: tuple[TableSpec, ...]

    def resolved(self) -> PipelineSpec:
        """Every table with its database: its own, or else the one that the source URL names."""
        return replace(self, tables=tuple(t if t.database else replace(t, database=self.source.database) for t in self.tables))

    def problems(self) -> list[str]:
        out = []
        url = urlsplit(self.source.url)
        if not self.source.url.strip():
            out.append("source.url is required")
        elif not url.scheme or not url.hostname:
            out.append("source.url is no URL with a host")
        elif not (self.source.allow_insecure or is_loopback(url.hostname) or parse_qs(url.query).get("require_ssl") == ["true"]):
            out.append("source.url must set require_ssl=true for a host that is not loopback, unless allow_insecure is set")
        if self.source.server_id == 0:
            out.append("source.server_id must be unique and positive")
        host = urlsplit(self.search.host)
        if not self.search.host.strip():
            out.append("search.host is required")
        elif host.scheme not in ("http", "https"):
            out.append("search.host must be an http or https URL")
        elif not host.hostname:
            out.append("search.host has no host name")
        elif host.scheme == "http" and not (self.search.allow_insecure or is_loopback(host.hostname)):
            out.append("search.host must use https for a host that is not loopback, unless allow_insecure is set")
        positive = [(self.search, "search", ("batch_size", "max_in_flight_tasks")), (self.runtime, "runtime", ("flush_interval_ms", "checkpoint_every_events"))]
        out += [f"{name}.{n} must be positive" for spec, name, names in positive for n in names if getattr(spec, n) <= 0]
        if not self.tables:
            out.append("at least one table is required")
        for t in self.tables:
            out += t.problems()
        known = self.resolved().tables
        out += [f"{d or '(no database)'}.{t} is mapped to {i} twice" for d, t, i in _repeated((t.database, t.table, t.index) for t in known)]
        out += [f"table {t.table!r}: no database, and source.url names none" for t in known if not t.database]
        return out

    def checked(self) -> PipelineSpec:
        if found := self.problems():
            raise SpecError("; ".join(found))
        return self.resolved()


def _repeated(values: Iterable) -> list:
    seen, out = set(), []
    for v in values:
        if v in seen and v not in out:
            out.append(v)
        seen.add(v)
    return out


def is_loopback(host: str) -> bool:
    if host.lower() == "localhost":
        return True
    try:
        return ipaddress.ip_address(host.strip("[]")).is_loopback
    except ValueError:
        return False


def secret(name: str, env: Mapping[str, str]) -> str | None:
    """The value of ``name``, or of the file that ``name``_FILE names without its final line ends; both is an error."""
    direct, path = env.get(name), env.get(f"{name}_FILE")
    if direct is not None and path is not None:
        raise SpecError(f"set {name} or {name}_FILE, not both")
    value = Path(path).read_text(encoding="utf-8").rstrip("\r\n") if path is not None else direct
    if value == "":
        raise SpecError(f"{name} is empty")
    return value


def _build(kind: type, values: Mapping[str, object]):
    known = {f.name for f in fields(kind)}
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known})


def parse(text: str, env: Mapping[str, str] | None = None) -> PipelineSpec:
    """A checked specification from TOML with sections source, search, runtime and [[tables]]."""
    env = os.environ if env is None else env
    raw = tomllib.loads(text)
    source, search = dict(raw.get("source", {})), dict(raw.get("search", {}))
    if url := secret(SOURCE_URL_ENV, env):
        source["url"] = url
    if key := secret(SEARCH_KEY_ENV, env):
        search["api_key"] = key
    blank = {"table": "", "index": "", "primary_key": "", "fields": ()}
    tables = tuple(_build(TableSpec, blank | t) for t in raw.get("tables", ()))
    return PipelineSpec(_build(SourceSpec, source), _build(SearchSpec, search), _build(RuntimeSpec, raw.get("runtime", {})), tables).checked()


def load(path: str | Path, env: Mapping[str, str] | None = None) -> PipelineSpec:
    return parse(Path(path).read_text(encoding="utf-8"), env)
