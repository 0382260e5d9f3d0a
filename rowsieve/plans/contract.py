"""The declarative contract: load, substitute, check."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from rowsieve.sources.files import as_schema, normalise_path, path_exists

# The keys and type names contracts are written with.
REQUIRED_KEYS = ("name", "sources", "transformations", "sinks")
VALIDATE = "validate_fields"
ADD_TIME = "add_timestamp"
STEP_TYPES = (VALIDATE, ADD_TIME)
ENVIRONMENT = "env_catalog"

_PLACEHOLDER = re.compile(r"\{([A-Za-z_]\w*)\}")


class ContractError(ValueError):
    """The contract has the wrong shape."""


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    fmt: str = "json"
    schema: T.StructType | None = None
    rescue: bool = False
    options: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Step:
    """``add_timestamp`` gives ``<name>``. ``validate_fields`` gives ``<name>_ok`` and
    ``<name>_ko``, and for sinks that keep both sides in one store, ``<name>`` itself."""

    name: str
    type: str
    input: str | None = None
    params: Mapping[str, object] = field(default_factory=dict)

    @property
    def outputs(self) -> tuple[str, ...]:
        if self.type == VALIDATE:
            return (f"{self.name}_ok", f"{self.name}_ko")
        return (self.name,)


@dataclass(frozen=True)
class Sink:
    name: str
    paths: tuple[str, ...]
    input: str
    fmt: str = "parquet"
    mode: str = "append"
    cluster_by: tuple[str, ...] = ()
    table: str | None = None


@dataclass(frozen=True)
class Summary:
    """A grouped summary of a sink's rows, written to ``path`` or ``table``.

    With ``parts`` each load adds its share there and the summary is merged from those;
    without, it is computed from all rows of the sink again.
    """

    name: str
    input: str
    by: tuple[str, ...]
    value: str
    path: str | None = None
    table: str | None = None
    parts: str | None = None
    fmt: str = "parquet"
    count_as: str = "total_employees"
    mean_as: str = "average_age"


@dataclass(frozen=True)
class Dataflow:
    name: str
    sources: tuple[Source, ...]
    steps: tuple[Step, ...]
    sinks: tuple[Sink, ...]
    summaries: tuple[Summary, ...] = ()

    def parents(self) -> dict[str, str]:
        """What each step output is made from."""
        return {output: step.input for step in self.steps for output in step.outputs}

    def validations(self) -> dict[str, Step]:
        return {step.name: step for step in self.steps if step.type == VALIDATE}

    def origin(self, name: str) -> str:
        """The source that ``name`` descends from."""
        parents = self.parents() | {n: step.input for n, step in self.validations().items()}
        while name in parents:
            name = parents[name]
        return name


def substitute(value, params: Mapping[str, str]):
    """Replace ``{key}`` in every string of a parsed contract; unknown keys stay."""
    if isinstance(value, str):
        return _PLACEHOLDER.sub(lambda match: str(params.get(match[1], match[0])), value)
    if isinstance(value, list):
        return [substitute(item, params) for item in value]
    if isinstance(value, dict):
        return {key: substitute(item, params) for key, item in value.items()}
    return value


def _path(value: object, owner: str) -> str:
    if not isinstance(value, str) or not value:
        raise ContractError(f"{owner} needs a path")
    open_key = _PLACEHOLDER.search(value)
    if open_key:
        raise ContractError(f"{owner}: no value for {open_key[0]} in {value!r}")
    return value


def _source(spec: Mapping) -> Source:
    name = spec.get("name")
    if not name:
        raise ContractError(f"a source needs a name: {dict(spec)}")
    schema = spec.get("schema")
    return Source(
        name=name,
        path=_path(spec.get("path"), f"source {name!r}"),
        fmt=str(spec.get("format", "json")).lower(),
        schema=None if schema is None else as_schema(schema),
        rescue=bool(spec.get("rescue", False)),
        options=dict(spec.get("options") or {}),
    )


def _steps(specs: Sequence[Mapping], sources: Sequence[Source]) -> tuple[Step, ...]:
    steps: list[Step] = []
    known = [source.name for source in sources]
    for position, spec in enumerate(specs):
        kind = spec.get("type")
        if kind not in STEP_TYPES:
            raise ContractError(f"step type {kind!r} is not one of {list(STEP_TYPES)}")
        params = dict(spec.get("params") or {})
        source_input = params.get("input", sources[0].name)
        if source_input not in known:
            raise ContractError(f"step input {source_input!r} is unknown; there are {known}")
        step = Step(spec.get("name") or f"step{position}", kind, source_input, params)
        if kind == VALIDATE and not isinstance(params.get("validations", []), list):
            raise ContractError(f"step {step.name!r}: validations must be a list")
        clash = {*step.outputs, step.name} & {*known, *(other.name for other in steps)}
        if clash:
            raise ContractError(f"step {step.name!r} redefines {sorted(clash)}")
        known.extend(step.outputs)
        steps.append(step)
    return tuple(steps)


def _wants_rejects(spec: Mapping) -> bool:
    named = str(spec.get("input") or spec.get("name") or "")
    return re.split(r"[_-]", named)[-1].lower() == "ko"


def _sink_input(name: str, spec: Mapping, steps: Sequence[Step], sources: Sequence[Source]) -> str:
    declared = spec.get("input")
    if declared:
        return declared
    checks = [step for step in steps if step.type == VALIDATE]
    side = re.split(r"[_-]", name)[-1].lower()
    if checks and side in ("ok", "ko"):
        return f"{checks[-1].name}_{side}"
    if not checks and side == "ok":
        return steps[-1].outputs[-1] if steps else sources[0].name
    raise ContractError(f"sink {name!r} has no input, and its name does not end in ok or ko")


def _sink(spec: Mapping, steps, sources, aliases: Mapping[str, str]) -> Sink:
    name = spec.get("name")
    if not name:
        raise ContractError(f"a sink needs a name: {dict(spec)}")
    paths = spec.get("paths") or []
    if not isinstance(paths, list) or not paths:
        raise ContractError(f"sink {name!r} needs a list of paths")
    wanted = _sink_input(name, spec, steps, sources)
    wanted = aliases.get(wanted, wanted)
    known = [source.name for source in sources]
    known += [output for step in steps for output in step.outputs]
    stores = [step.name for step in steps if step.type == VALIDATE]
    if wanted not in known + stores:
        raise ContractError(f"sink {name!r}: input {wanted!r} is unknown; there are {known}")
    mode = str(spec.get("mode") or spec.get("saveMode") or "append").lower()
    if mode not in ("append", "overwrite"):
        raise ContractError(f"sink {name!r}: mode {mode!r} is neither append nor overwrite")
    cluster = spec.get("cluster_by") or ()
    if wanted in stores and (cluster or spec.get("table")):
        raise ContractError(f"sink {name!r}: a store has no cluster_by and no table")
    return Sink(
        name=name,
        paths=tuple(_path(path, f"sink {name!r}") for path in paths),
        input=wanted,
        fmt=str(spec.get("format", "parquet")).lower(),
        mode=mode,
        cluster_by=(cluster,) if isinstance(cluster, str) else tuple(cluster),
        table=spec.get("table"),
    )


def _summary(spec: Mapping, sinks: Sequence[Sink]) -> Summary:
    name = spec.get("name")
    if not name or not spec.get("by") or not spec.get("value"):
        raise ContractError(f"a summary needs name, input, by and value: {dict(spec)}")
    if spec.get("input") not in {sink.name for sink in sinks}:
        raise ContractError(f"summary {name!r}: input must be the name of a sink")
    if not spec.get("path") and not spec.get("table"):
        raise ContractError(f"summary {name!r} needs a path or a table")
    by = spec["by"]
    return Summary(
        name=name,
        input=spec["input"],
        by=(by,) if isinstance(by, str) else tuple(by),
        value=spec["value"],
        path=spec.get("path"),
        table=spec.get("table"),
        parts=spec.get("parts"),
        fmt=str(spec.get("format", "parquet")).lower(),
        count_as=spec.get("count_as") or ("total_employees" if spec["value"] == "age" else "total_rows"),
        mean_as=spec.get("mean_as") or f"average_{spec['value']}",
    )


def _check_places(sources, sinks: Sequence[Sink], summaries: Sequence[Summary]) -> None:
    """No output may be, hold or lie in another output or a source: replacing one would take
    the other with it."""
    places = [(f"source {source.name!r}", normalise_path(source.path)) for source in sources]
    outputs = [(f"sink {sink.name!r}", path) for sink in sinks for path in sink.paths]
    for summary in summaries:
        written = (summary.path, summary.parts)
        outputs += [(f"summary {summary.name!r}", path) for path in written if path]
    for owner, path in outputs:
        inside = path.rstrip("/") + "/"
        for other, taken in places:
            holds = taken.rstrip("/") + "/"
            if inside.startswith(holds) or holds.startswith(inside):
                raise ContractError(f"{owner} and {other} share the place {path!r}")
        places.append((owner, path))


def parse_contract(
    contract: Mapping,
    params: Mapping[str, str] | None = None,
    *,
    aliases: Mapping[str, str] | None = None,
) -> Dataflow:
    """Check a parsed contract and give its :class:`Dataflow`.

    ``aliases`` maps sink inputs no step produces to ones that exist. Rules are checked against
    the data's schema later, when the steps are bound to frames.
    """
    if not isinstance(contract, Mapping):
        raise ContractError("a contract is a JSON object")
    missing = [key for key in REQUIRED_KEYS if key not in contract]
    if missing:
        raise ContractError(f"contract without {missing}")
    contract = substitute(dict(contract), params or {})
    for key in ("sources", "transformations", "sinks"):
        if not isinstance(contract[key], list):
            raise ContractError(f"{key} must be a list")
    if not contract["sources"]:
        raise ContractError("a contract needs at least one source")
    sources = tuple(_source(spec) for spec in contract["sources"])
    if len({source.name for source in sources}) != len(sources):
        raise ContractError("two sources have the same name")
    steps = _steps(contract["transformations"], sources)
    if not any(step.type == VALIDATE for step in steps) and any(map(_wants_rejects, contract["sinks"])):
        # Without rules every row is valid, and a sink for rejected rows is empty, with their columns.
        last = steps[-1].outputs[-1] if steps else sources[0].name
        steps = (*steps, Step("validate", VALIDATE, last, {"validations": []}))
    sinks = tuple(_sink(spec, steps, sources, aliases or {}) for spec in contract["sinks"])
    summaries = tuple(_summary(spec, sinks) for spec in contract.get("summaries") or [])
    _check_places(sources, sinks, summaries)
    return Dataflow(contract["name"], sources, steps, sinks, summaries)


def load_contract(
    path: str | Path,
    params: Mapping[str, str] | None = None,
    *,
    aliases: Mapping[str, str] | None = None,
    spark: SparkSession | None = None,
) -> Dataflow:
    """Read a contract file. A missing file, bad JSON and a bad shape raise
    ``FileNotFoundError``, ``json.JSONDecodeError`` and :class:`ContractError`.

    With a ``spark`` session the path may be in any store that Spark reads.
    """
    if spark is None:
        text = Path(path).read_text(encoding="utf-8")
    elif path_exists(spark, str(path)):
        text = spark.read.text(str(path), wholetext=True).first()[0]
    else:
        raise FileNotFoundError(str(path))
    return parse_contract(json.loads(text), params, aliases=aliases)
