"""Named stages over DataFrames: built lazily in order, validated, failing loudly."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import DataFrame

from scholarmesh.sources.schemas import validate

log = logging.getLogger("scholarmesh")


class PipelineError(ValueError):
    """A stage that can't be added or run."""


@dataclass(frozen=True)
class Stage:
    """run(config, inputs) gives the table `output`, which keeps the contract `schema` if one is named; accepts names the
    contracts that inputs must keep. optional: without
    its inputs, or where run gives None, the first input is passed on under its output name. keep: persist the output,
    for one that several later stages read."""

    name: str
    run: Callable[["Config", dict[str, DataFrame]], DataFrame | None]
    inputs: Sequence[str]
    output: str
    schema: str | None = None
    optional: bool = False
    keep: bool = False
    accepts: Mapping[str, str] = field(default_factory=dict)


@dataclass
class Config:
    """One evidence type: its source and modules, any of which may be absent."""

    name: str
    source: Callable[[], DataFrame]
    analyser: Callable[[DataFrame], DataFrame] | None = None
    matcher: Callable[[DataFrame], DataFrame] | None = None
    scorer: Callable[[DataFrame], DataFrame] | None = None
    filters: Sequence[Callable[[DataFrame], DataFrame]] = ()
    editors: Sequence[Callable[[DataFrame], DataFrame]] = ()
    tables: dict[str, DataFrame] = field(default_factory=dict)


def _chain(functions: Sequence[Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: reduce(lambda d, f: d.transform(f), functions, df)


def standard_stages(scores: str | None = None) -> list[Stage]:
    """Initialise, analyse, match, filter, score, edit. scores: the contract that scored pairs keep, before and after editing."""
    module = lambda attr, src: lambda c, t: getattr(c, attr)(t[src]) if getattr(c, attr) else None
    return [
        Stage("initialisation", lambda c, _: c.source(), [], "input"),
        Stage("analyser", module("analyser", "input"), ["input"], "analysed", optional=True),
        Stage("matcher", module("matcher", "analysed"), ["analysed"], "matched", optional=True),
        Stage("filter", lambda c, t: _chain(c.filters)(t["matched"]), ["matched"], "filtered", optional=True),
        Stage("scoring", module("scorer", "filtered"), ["filtered"], "scored", scores, optional=True),
        Stage("match editor", lambda c, t: _chain(c.editors)(t["scored"]), ["scored"], "edited", scores, optional=True, accepts={"scored": scores} if scores else {}),
    ]


class Pipeline:
    def __init__(self) -> None:
        self.stages: list[Stage] = []
        self.configs: list[Config] = []

    def add_stage(self, stage: Stage) -> "Pipeline":
        if any(stage.output == s.output or stage.name == s.name for s in self.stages):
            raise PipelineError(f"{stage.name}: there is a stage of this name or output already")
        known = {s.output for s in self.stages}
        if missing := [i for i in stage.inputs if i not in known]:
            raise PipelineError(f"{stage.name}: no stage makes {', '.join(missing)}")
        self.stages.append(stage)
        return self

    def add_config(self, config: Config) -> "Pipeline":
        if any(config.name == c.name for c in self.configs):
            raise PipelineError(f"{config.name}: there is a config of this name already")
        self.configs.append(config)
        return self

    def reset(self, stages: bool = False) -> None:
        """Forgets the tables, and the stages too if asked."""
        for c in self.configs:
            c.tables.clear()
        if stages:
            self.stages.clear()

    def fork(self) -> "Pipeline":
        """A pipeline of the same stages, without configs."""
        p = Pipeline()
        p.stages = list(self.stages)
        return p

    def run(self) -> "Pipeline":
        """Builds the plan of every config; nothing is computed but what a stage asks for itself."""
        for c in self.configs:
            for s in self.stages:
                self._run_stage(c, s)
        return self

    def _run_stage(self, c: Config, s: Stage) -> None:
        for i, contract in s.accepts.items():
            validate(c.tables[i], contract)
        out = s.run(c, {i: c.tables[i] for i in s.inputs})
        if out is None:
            if not s.optional or not s.inputs:
                raise PipelineError(f"{c.name}, {s.name}: no output")
            out = c.tables[s.inputs[0]]
            log.info("%s: %s skipped", c.name, s.name)
        elif s.schema:
            validate(out, s.schema)
        c.tables[s.output] = out.persist() if s.keep else out

    def table(self, config: str, output: str) -> DataFrame:
        return next(c for c in self.configs if c.name == config).tables[output]

    def union(self, output: str) -> DataFrame:
        """The table of all configs together, columns aligned by name."""
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [c.tables[output] for c in self.configs])


@dataclass(frozen=True)
class Settings:
    """Defaults that runs take; each may be given instead."""

    safe_divisor: int = 20
    score_factor: float = 3.0
    ngram: int = 4
    most_documents: int = 2000
    least_cosine: float = 0.3
    picture_threshold: int = 30
    percentile: int = 99
    kinds: tuple[str, ...] = ("person", "formula", "text", "abstract", "cosine_title", "referenced_doi", "referenced_proposal_code", "laboratory", "picture", "instrument")
    trained: tuple[str, ...] = ("person", "formula", "text", "cosine_title", "abstract", "picture", "instrument")
    window: int = 8
    areas: int = 40
    fixed_weights: tuple[tuple[str, float], ...] = (("doi", 1.0), ("proposal_code", 1.0))

    @classmethod
    def from_environment(cls, prefix: str = "SCHOLARMESH_", **given: object) -> "Settings":
        """The defaults, in place of them whole and broken numbers from the environment (SCHOLARMESH_WINDOW=4 for window), in
        place of both what is given."""
        found: dict[str, object] = {}
        for f in fields(cls):
            text = os.environ.get(prefix + f.name.upper())
            if text is not None and isinstance(f.default, (int, float)):
                found[f.name] = type(f.default)(text)
        return cls(**found | given)
