"""Dataset registry and configuration: driver-side values, no data."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

_HERE = Path(__file__).resolve().parent / "config"
_IMAGE_SUFFIXES = {".jpg", ".jpeg", ".png"}


def load_config(overrides: str | Path | None = None) -> dict:
    """Settings and datasets merged; a JSON file of overrides is merged on top, section by section.

    ``.yaml`` files are read too where a YAML library is installed.
    """
    config = json.loads((_HERE / "settings.json").read_text()) | {"datasets": json.loads((_HERE / "datasets.json").read_text())}
    if overrides:
        path = Path(overrides)
        if path.suffix in (".yaml", ".yml"):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("reading YAML needs a YAML library; use JSON instead") from e
            more = yaml.safe_load(path.read_text())
        else:
            more = json.loads(path.read_text())
        for key, value in more.items():
            config[key] = config[key] | value if isinstance(value, dict) and isinstance(config.get(key), dict) else value
    return config


@dataclass
class DatasetSpec:
    key: str
    name: str
    modality: str
    task: str
    source: str
    raw_subdir: str
    dataset_version: str = "unknown"
    label_map: dict[str, int] = field(default_factory=dict)
    expected_files: list[str] = field(default_factory=list)
    urls: dict[str, str] = field(default_factory=dict)
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, key: str, values: dict) -> DatasetSpec:
        """Known keys become fields, all others go to ``extra``; a missing mandatory key raises KeyError."""
        known = {"name", "modality", "task", "source", "raw_subdir", "dataset_version", "label_map", "expected_files", "urls"}
        for mandatory in ("name", "modality", "task", "source", "raw_subdir"):
            if mandatory not in values:
                raise KeyError(mandatory)
        return cls(key, **{k: v for k, v in values.items() if k in known}, extra={k: v for k, v in values.items() if k not in known})


class DatasetManager:
    def __init__(self, specs: dict[str, DatasetSpec], paths: dict[str, str], root: str | Path = "."):
        self._specs, self._paths, self._root = dict(specs), paths, Path(root)

    @classmethod
    def from_config(cls, config: dict, root: str | Path = ".") -> DatasetManager:
        return cls({k: DatasetSpec.from_dict(k, v) for k, v in config["datasets"].items()}, config["paths"], root)

    def list_keys(self) -> list[str]:
        return list(self._specs)

    def get(self, key: str) -> DatasetSpec:
        if key not in self._specs:
            raise KeyError(f"unknown dataset {key!r}; known: {', '.join(self._specs)}")
        return self._specs[key]

    def register(self, key: str, spec: DatasetSpec) -> None:
        self._specs[key] = spec

    def _keys(self, test: Callable[[DatasetSpec], bool]) -> list[str]:
        return [k for k, s in self._specs.items() if test(s)]

    def by_modality(self, modality: str) -> list[str]:
        return self._keys(lambda s: s.modality == modality)

    def by_task(self, task: str) -> list[str]:
        return self._keys(lambda s: s.task == task)

    def raw_dir(self, key: str) -> Path:
        return self._root / self._paths["raw_dir"] / self.get(key).raw_subdir

    def processed_path(self, key: str) -> Path:
        return self._root / self._paths["processed_dir"] / f"{key}.parquet"

    def lineage_path(self, key: str) -> Path:
        return self._root / self._paths["lineage_dir"] / f"{key}.lineage.json"

    def splits_dir(self, key: str) -> Path:
        return self._root / self._paths["splits_dir"] / key

    def profiling_path(self) -> Path:
        return self._root / self._paths["profiling_dir"] / "profiling_report.md"

    def eda_path(self) -> Path:
        return self._root / self._paths["eda_dir"] / "eda_report.md"

    def status(self, key: str) -> dict[str, bool]:
        spec, raw = self.get(key), self.raw_dir(key)
        if spec.modality == "image":
            have = raw.exists() and any(p.suffix.lower() in _IMAGE_SUFFIXES for p in raw.rglob("*"))
        elif spec.expected_files:
            have = all(dataset_status(raw, spec.expected_files).values())
        else:
            have = raw.exists() and any(p.is_file() and not p.name.startswith(".") for p in raw.iterdir())
        split = self.splits_dir(key)
        return {"downloaded": have, "cleaned": self.processed_path(key).exists(), "split": split.exists() and any(split.iterdir())}

    def status_report(self) -> dict[str, dict[str, bool]]:
        return {k: self.status(k) for k in self._specs}


def dataset_status(raw_dir: str | Path, files: list[str]) -> dict[str, bool]:
    """Which of the files are there and not empty."""
    paths = {name: Path(raw_dir) / name for name in files}
    return {name: p.exists() and p.stat().st_size > 0 for name, p in paths.items()}
