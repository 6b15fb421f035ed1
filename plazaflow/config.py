"""Site configuration: everything that differs from one place to the next."""

from __future__ import annotations

from pathlib import Path

DEFAULT = Path(__file__).with_name("site.yml")


def load_config(path: str | Path = DEFAULT) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))
