"""Staged pipelines from YAML: named tasks, their dependencies and where their results go."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

Task = Callable[..., DataFrame]
TASKS: dict[str, Task] = {}


def task(name: str):
    """Registers a task: a function of a DataFrame and keyword parameters."""

    def register(f: Task) -> Task:
        if name in TASKS:
            raise ValueError(f"task {name} is there already")
        TASKS[name] = f
        return f

    return register


class _Loader(yaml.SafeLoader):
    """YAML in which the keys of ``stages`` may repeat: mappings there become lists of pairs."""


def _pairs(loader, node):
    pairs = [(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value]
    keys = [k for k, _ in pairs]
    return dict(pairs) if len(set(keys)) == len(keys) else pairs


_Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _pairs)


def load(text: str) -> dict:
    return yaml.load(text, Loader=_Loader)  # noqa: S506  a SafeLoader


@dataclass
class Step:
    """One task of a plan; ``ref`` is unique in it."""

    ref: str
    stage: str
    task: str
    output: str
    depends_on: str | None = None
    params: dict = field(default_factory=dict)


def plan(config: dict) -> list[Step]:
    """The steps of a config ``{output_dir, stages: {stage: {task: {depends_on, ...}}}}``.

    A task that comes again in its stage gets ``#n`` in its ref and ``_dup{n-1}`` in its
    folder. A first step reads the input; every other names a step before it, by
    its ref, by stage and task, or by the task alone if that is unique.
    """
    if not config.get("stages"):
        raise ValueError("a pipeline needs stages")
    steps: list[Step] = []
    seen: dict[tuple[str, str], int] = {}
    stages = config["stages"]
    for stage, tasks in stages.items() if isinstance(stages, dict) else stages:
        for name, params in tasks.items() if isinstance(tasks, dict) else tasks:
            params = dict(params or {})
            if name not in TASKS:
                raise ValueError(f"{stage}: no task {name}")
            n = seen[stage, name] = seen.get((stage, name), 0) + 1
            folder = f"{config.get('output_dir', '.')}/{stage}/{name}" + (f"_dup{n - 1}" if n > 1 else "")
            wanted = params.pop("depends_on", None)
            if steps and wanted is None:
                raise ValueError(f"{stage}/{name} must say what it depends on")
            steps.append(Step(f"{stage}/{name}" + (f"#{n}" if n > 1 else ""), stage, name, folder, resolve(wanted, steps), params))
    return steps


def resolve(wanted: str | None, steps: list[Step]) -> str | None:
    """The ref or path that a dependency names among the steps so far."""
    if wanted is None:
        return None
    exact = [s.ref for s in steps if s.ref == wanted]
    named = exact or [s.ref for s in steps if s.task == wanted]
    if len(named) > 1:
        raise ValueError(f"{wanted} may be any of {named}")
    if named:
        return named[0]
    if "/" in wanted and Path(wanted).suffix or "://" in wanted:
        return wanted
    raise ValueError(f"nothing before is called {wanted}")


def run(spark: SparkSession, config: dict, table: DataFrame, write: bool = True) -> dict[str, DataFrame]:
    """The result of every step, lazy; with ``write`` each is stored and read back."""
    done: dict[str, DataFrame] = {}
    for step in plan(config):
        source = table if step.depends_on is None else done.get(step.depends_on)
        if source is None:
            source = spark.read.parquet(step.depends_on)
        out = TASKS[step.task](source, **step.params)
        if write:
            out.write.mode("overwrite").parquet(step.output)
            out = spark.read.parquet(step.output)
        done[step.ref] = out
    return done


@task("flatten")
def _flatten(rows: DataFrame, anchor_col: str, split_col_list: list[str]) -> DataFrame:
    from vistaloom.operators.reshape import unnest

    return unnest(rows, anchor_col, split_col_list)


@task("group")
def _group(rows: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    from vistaloom.operators.reshape import group_collect

    return group_collect(rows, key, columns, order)


@task("filter")
def _filter(rows: DataFrame, condition: str) -> DataFrame:
    return rows.filter(condition)


@task("select")
def _select(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*columns)


@dataclass
class Split:
    name: str
    inputs: list[str]


@dataclass
class Dataset:
    """A data set's config: its splits' inputs, adapter and overrides."""

    name: str
    splits: list[Split]
    adapter: str = "passthrough"
    params: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


def datasets(root: str) -> list[Dataset]:
    """The configs ``*/dataset.yaml`` one level below a folder, by name, or one file."""
    path = Path(root)
    found = []
    for file in [path] if path.is_file() else sorted(path.glob("*/dataset.yaml")):
        raw = yaml.safe_load(file.read_text())
        splits = [Split(s["name"], list(s.get("inputs", []))) for s in raw.get("splits", [])]
        known = {"name", "splits", "adapter", "params"}
        found.append(Dataset(raw["name"], splits, raw.get("adapter", "passthrough"), raw.get("params", {}), {k: v for k, v in raw.items() if k not in known}))
    return found


def qa_tasks(text: str, overrides: dict | None = None) -> dict[str, dict]:
    """Enabled question tasks by name with their parameters; overrides win."""
    out = {}
    for name, raw in (yaml.safe_load(text) or {}).get("qa_tasks", {}).items():
        if raw.get("enabled", True):
            out[name] = {"type": raw.get("type", name), "params": {**raw.get("params", {}), **(overrides or {}).get(name, {})}}
    return out
