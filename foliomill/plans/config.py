"""Run configuration: a YAML file or a mapping, read on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

ORDER = ("layout", "line", "htr")


@dataclass
class Config:
    """Settings of a run; tasks come in the fixed order layout, line, htr."""

    run_name: str = "unknown"
    output_dir: str = "./results/"
    reading_order: str = "dbscan"
    save_image: bool = True
    use_metadata: bool = False
    data: dict[str, list[str]] = field(default_factory=dict)
    tasks: dict[str, dict[str, Any]] = field(default_factory=dict)

    @classmethod
    def of(cls, values: dict[str, Any]) -> Config:
        own = {k: values[k] for k in ("run_name", "output_dir", "reading_order", "save_image", "use_metadata") if values.get(k) is not None}
        paths = {k: [v] if isinstance(v, str) else list(v) for k, v in (values.get("data") or {}).items() if v}
        tasks = values.get("tasks") or {}
        if unknown := set(tasks) - set(ORDER):
            raise ValueError(f"unknown task {sorted(unknown)[0]!r}; known: {', '.join(ORDER)}")
        return cls(**own, data=paths, tasks={k: tasks[k] for k in ORDER if k in tasks})

    @classmethod
    def read(cls, path: str) -> Config:
        import yaml

        with open(path) as f:
            return cls.of(yaml.safe_load(f) or {})
