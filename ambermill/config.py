"""Environment configuration, feature-group files and path resolution."""

from __future__ import annotations

import os
from pathlib import Path

import yaml

PACKAGE_CONF = Path(__file__).parent / "conf"


def load_config(env: str | None = None, folder: str | Path = PACKAGE_CONF) -> dict:
    """Read <folder>/<env>.yaml; env falls back to $APP_ENV, then "local"."""
    name = env or os.environ.get("APP_ENV") or "local"
    file = Path(folder) / f"{name}.yaml"
    if not file.is_file():
        choices = sorted(p.stem for p in Path(folder).glob("*.yaml") if p.stem != "features")
        raise FileNotFoundError(f"no configuration {name!r}; choose one of {choices}")
    return yaml.safe_load(file.read_text())


def load_feature_groups(path: str | Path = PACKAGE_CONF / "features.yaml") -> dict:
    """Raw feature-group definitions; ambermill.plans.specs turns them into typed specs."""
    return yaml.safe_load(Path(path).read_text())["feature_groups"]


def resolve_path(path: str, root: str | Path | None = None) -> str:
    """URLs and absolute paths stay as they are; relative ones start at root (or the working folder)."""
    if "://" in path or os.path.isabs(path):
        return path
    return str(Path(root or os.getcwd()) / path)


def table_path(base: str, *parts: str) -> str:
    """Join URL-safely: exactly one slash between parts."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])
