"""Settings of a run: curated versions per project and typed parameters, from one YAML file."""

from __future__ import annotations

import dataclasses
import os
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

from folium.operators.packing import PackingConfig


@dataclasses.dataclass(frozen=True)
class DedupConfig:
    near_duplicate_check: bool
    near_duplicate_threshold: float


@dataclasses.dataclass(frozen=True)
class SplitConfig:
    seed: int
    test_fraction: float
    val_fraction: float


@dataclasses.dataclass(frozen=True)
class QAConfig:
    max_pairs_per_document: int
    llm_model: str
    enable_llm_judge: bool


@dataclasses.dataclass(frozen=True)
class PipelineConfig:
    chunking: PackingConfig
    dedup: DedupConfig
    split: SplitConfig
    qa: QAConfig


@dataclasses.dataclass(frozen=True)
class ProjectSource:
    project: str
    canonical_version: str
    reason: str
    path: Path


def load_yaml(path: str | Path) -> dict[str, Any]:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def load_pipeline(path: str | Path) -> PipelineConfig:
    """Typed parameters; a missing or unknown key is a TypeError."""
    parts = {f.name: f.type for f in dataclasses.fields(PipelineConfig)}
    kinds = {"PackingConfig": PackingConfig, "DedupConfig": DedupConfig, "SplitConfig": SplitConfig, "QAConfig": QAConfig}
    raw = load_yaml(path)["pipeline"]
    made = {}
    for name, values in raw.items():
        kind = kinds.get(parts.get(name, ""), None)
        if kind is None:
            raise TypeError(f"unknown part {name!r} of the pipeline settings")
        wanted, given = {f.name for f in dataclasses.fields(kind)}, set(values or {})
        if wanted != given:
            raise TypeError(f"{name}: missing {sorted(wanted - given)}, unknown {sorted(given - wanted)}")
        made[name] = kind(**values)
    return PipelineConfig(**made)


def load_sources(path: str | Path, root: str | Path) -> dict[str, ProjectSource]:
    """Curated version folder of every project; a folder that is not there is a FileNotFoundError."""
    out = {}
    for project, entry in load_yaml(path)["canonical_sources"]["projects"].items():
        version = str(entry["canonical"])
        folder = Path(root) / project / version
        if not folder.is_dir():
            raise FileNotFoundError(f"project {project!r} has no folder for version {version!r}: {folder}")
        out[project] = ProjectSource(project, version, str(entry.get("reason") or "").strip(), folder)
    return out


def sources_table(spark: SparkSession, sources: dict[str, ProjectSource]) -> DataFrame:
    """The curated sources as a small table."""
    rows = [(s.project, s.canonical_version, s.reason, str(s.path)) for s in sources.values()]
    return spark.createDataFrame(rows, "project string, canonical_version string, reason string, source_root string")


def load_env(path: str | Path) -> None:
    """``KEY=value`` lines of a file into the environment, where not set already."""
    p = Path(path)
    for line in p.read_text(encoding="utf-8").splitlines() if p.exists() else []:
        key, sep, value = line.partition("=")
        if sep and not key.lstrip().startswith("#"):
            os.environ.setdefault(key.strip().removeprefix("export "), value.strip().strip("'\""))
