"""The policy: which columns are masked, as what, and how replacements must look. Strict: nothing unknown is let through."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from pathlib import Path, PurePosixPath
from typing import Any

import yaml

from ..errors import PolicyError

ENTITIES = ("person_name", "email", "phone", "address")
#: The only normalisation of each entity type.
NORMALIZATION_OF = {"person_name": "human_text", "address": "human_text", "email": "email", "phone": "phone"}
TEXT_TYPES = ("string", "text", "character varying", "character", "varchar", "char")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]{0,62}")
_ENV = re.compile(r"[A-Z_][A-Z0-9_]*")


@dataclass(frozen=True, order=True)
class ColumnRef:
    schema: str
    table: str
    column: str

    def __post_init__(self) -> None:
        for part in (self.schema, self.table, self.column):
            if not isinstance(part, str) or not _IDENTIFIER.fullmatch(part):
                raise PolicyError("a column reference has an unsupported identifier")

    @classmethod
    def parse(cls, text: str) -> ColumnRef:
        parts = str(text).split(".")
        if len(parts) != 3:
            raise PolicyError("a column is written schema.table.column")
        return cls(*parts)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}.{self.column}"


@dataclass(frozen=True)
class Generation:
    description: str
    min_length: int
    max_length: int
    regex: str | None = None

    def accepts(self, value: str) -> bool:
        return bool(value) and self.min_length <= len(value) <= self.max_length and (self.regex is None or re.fullmatch(self.regex, value) is not None)


@dataclass(frozen=True)
class Group:
    entity_type: str
    locale: str
    normalization: str
    generation: Generation
    columns: tuple[ColumnRef, ...]
    allow_empty: bool = False


@dataclass(frozen=True)
class Policy:
    groups: dict[str, Group]
    allow_target_recreate: bool
    run_directory: str = ".runs"
    collector_fetch_size: int = 1000
    verifier_fetch_size: int = 1000
    source_env: str = "SOURCE_DSN"
    target_env: str = "TARGET_DSN"
    registry_name: str = "mappings"
    key_env: str = "MAPPING_HMAC_KEY"
    provider: str = "deterministic"
    batch_size: int = 25
    max_retries: int = 3
    temperature: float = 1.15
    timeout_seconds: int = 120
    base_url_env: str | None = None
    model: str | None = None
    model_env: str | None = None
    parallel_jobs: int = 1
    json_name: str = "report.json"
    markdown_name: str = "report.md"
    include_sample: bool = False
    sample_rows: int = 5
    sha256: str = ""
    _of: dict[ColumnRef, str] = field(default_factory=dict, compare=False, repr=False)

    def group_of(self, column: ColumnRef) -> str | None:
        return self._of.get(column)

    def columns(self) -> tuple[ColumnRef, ...]:
        return tuple(sorted(c for g in self.groups.values() for c in g.columns))

    def by_table(self) -> dict[str, dict[str, str]]:
        """Transform plan: table -> column -> group, in sorted order."""
        plan: dict[str, dict[str, str]] = {}
        for c in self.columns():
            plan.setdefault(f"{c.schema}.{c.table}", {})[c.column] = self._of[c]
        return plan


class _Section:
    """Takes fields out of a mapping, and complains of what is left. Errors name places, never values."""

    def __init__(self, raw: Any, at: str) -> None:
        if not isinstance(raw, dict):
            raise PolicyError(f"{at}: a mapping is needed")
        self.raw, self.at = dict(raw), at

    def take(self, name: str, kind: type | tuple, default: Any = ..., low: float | None = None, high: float | None = None) -> Any:
        if name not in self.raw:
            if default is ...:
                raise PolicyError(f"{self.at}.{name}: missing")
            return default
        value = self.raw.pop(name)
        if not isinstance(value, kind) or isinstance(value, bool) and kind is not bool:
            raise PolicyError(f"{self.at}.{name}: wrong type")
        size = len(value) if isinstance(value, str) else value
        if low is not None and size < low or high is not None and size > high:
            raise PolicyError(f"{self.at}.{name}: out of bounds")
        return value

    def env(self, name: str, default: Any = ...) -> Any:
        value = self.take(name, str, default)
        if value is not None and not _ENV.fullmatch(value):
            raise PolicyError(f"{self.at}.{name}: not the name of an environment variable")
        return value

    def leaf(self, name: str, default: str) -> str:
        value = self.take(name, str, default)
        if value in ("", ".", "..") or re.search(r"[/\\\0]", value) or PurePosixPath(value).is_absolute():
            raise PolicyError(f"{self.at}.{name}: a bare file name is needed")
        return value

    def section(self, name: str) -> _Section:
        return _Section(self.raw.pop(name, {}), f"{self.at}.{name}")

    def done(self) -> None:
        if self.raw:
            raise PolicyError(f"{self.at}: unknown field {sorted(map(str, self.raw))[0]}")


def _group(raw: Any, at: str) -> Group:
    s = _Section(raw, at)
    entity = s.take("entity_type", str)
    if entity not in ENTITIES:
        raise PolicyError(f"{at}.entity_type: unknown")
    if s.take("normalization", str) != NORMALIZATION_OF[entity]:
        raise PolicyError(f"{at}.normalization: doesn't fit the entity type")
    g = s.section("generation")
    low, high = g.take("min_length", int, low=1), g.take("max_length", int, low=1, high=10_000)
    regex = g.take("regex", str, None)
    generation = Generation(g.take("description", str, low=1, high=500), low, high, regex)
    g.done()
    if low > high:
        raise PolicyError(f"{at}.generation: min_length exceeds max_length")
    try:
        re.compile(regex or "")
    except re.error:
        raise PolicyError(f"{at}.generation.regex: doesn't compile") from None
    columns = tuple(ColumnRef.parse(c) if isinstance(c, str) else ColumnRef(**c) for c in s.take("columns", list))
    if not columns or len(set(columns)) < len(columns):
        raise PolicyError(f"{at}.columns: empty, or a column comes twice")
    group = Group(entity, s.take("locale", str, low=2, high=32), NORMALIZATION_OF[entity], generation, columns, s.take("allow_empty", bool, False))
    s.done()
    return group


def parse(raw: Any, sha256: str = "") -> Policy:
    root = _Section(raw, "policy")
    if root.take("version", int) != 1:
        raise PolicyError("policy.version: only 1 is known")
    run, con, mapping = root.section("run"), root.section("connections"), root.section("mapping")
    llm, out, report = root.section("llm"), root.section("output"), root.section("report")
    fields: dict[str, Any] = {
        "allow_target_recreate": run.take("allow_target_recreate", bool),
        "run_directory": run.take("directory", str, ".runs", low=1),
        "collector_fetch_size": run.take("collector_fetch_size", int, 1000, 1, 100_000),
        "verifier_fetch_size": run.take("verifier_fetch_size", int, 1000, 1, 100_000),
        "source_env": con.env("source_dsn_env", "SOURCE_DSN"),
        "target_env": con.env("target_dsn_env", "TARGET_DSN"),
        "registry_name": mapping.leaf("registry_filename", "mappings"),
        "key_env": mapping.env("hmac_key_env", "MAPPING_HMAC_KEY"),
        "provider": llm.take("provider", str, "deterministic"),
        "batch_size": llm.take("batch_size", int, 25, 1, 1000),
        "max_retries": llm.take("max_retries", int, 3, 0, 20),
        "temperature": float(llm.take("temperature", (int, float), 1.15, 0, 2)),
        "timeout_seconds": llm.take("timeout_seconds", int, 120, 1, 3600),
        "base_url_env": llm.env("base_url_env", None),
        "model": llm.take("model", str, None, low=1),
        "model_env": llm.env("model_env", None),
        "parallel_jobs": out.take("parallel_jobs", int, 1, 1, 32),
        "json_name": report.leaf("json_filename", "report.json"),
        "markdown_name": report.leaf("markdown_filename", "report.md"),
        "include_sample": report.take("include_synthetic_demo_before_after", bool, False),
        "sample_rows": report.take("sample_rows", int, 5, 0, 100),
    }
    if mapping.take("hmac_algorithm", str, "sha256") != "sha256":
        raise PolicyError("policy.mapping.hmac_algorithm: only sha256 is known")
    if not llm.take("structured_output", bool, True):
        raise PolicyError("policy.llm.structured_output: must be true")
    if fields["provider"] not in ("deterministic", "ollama", "openrouter"):
        raise PolicyError("policy.llm.provider: unknown")
    if fields["json_name"] == fields["markdown_name"]:
        raise PolicyError("policy.report: the two files need different names")
    raw_groups = root.take("groups", dict)
    if not raw_groups or not all(isinstance(k, str) and _IDENTIFIER.fullmatch(k) for k in raw_groups):
        raise PolicyError("policy.groups: at least one, with safe names")
    groups = {k: _group(v, f"policy.groups.{k}") for k, v in raw_groups.items()}
    for s in (run, con, mapping, llm, out, report, root):
        s.done()
    of: dict[ColumnRef, str] = {}
    for name, g in groups.items():
        for c in g.columns:
            if of.setdefault(c, name) != name:
                raise PolicyError(f"column {c.qualified} is in two groups")
    return Policy(groups=groups, sha256=sha256, _of=of, **fields)


def load(path: str | Path) -> Policy:
    """Policy of a YAML file, with the SHA-256 of its bytes."""
    try:
        data = Path(path).read_bytes()
        raw = yaml.safe_load(data)
    except (OSError, yaml.YAMLError):
        raise PolicyError("the policy can't be read as YAML") from None
    return parse(raw, hashlib.sha256(data).hexdigest())
