"""Command line: python -m ambermill.cli bronze|silver|train ..."""

from __future__ import annotations

import argparse
import json

from ambermill.config import load_config, resolve_path, table_path
from ambermill.plans.bronze import run_bronze
from ambermill.plans.runner import ORDER, build_silver
from ambermill.plans.training import load_training_data, save_artifact, train_gbt
from ambermill.registry import RunRegistry, code_version
from ambermill.session import build_session
from ambermill.sources.tables import read_table


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ambermill")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("bronze", "silver", "train"):
        s = sub.add_parser(name)
        s.add_argument("--env")
        s.add_argument("--profile")
        s.add_argument("--no-registry", action="store_true")
        if name == "bronze":
            for o in ("--raw-path", "--bronze-path", "--start", "--end"):
                s.add_argument(o)
        if name == "silver":
            s.add_argument("--groups", nargs="*", help=f"some of {', '.join(ORDER)}")
            s.add_argument("--force", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    config = load_config(a.env)
    paths = {k: resolve_path(v) for k, v in config["paths"].items()}
    spark = build_session(f"ambermill-{a.command}", config, a.profile)
    registry = None if a.no_registry else RunRegistry(paths["registry"])
    bronze = table_path(paths["bronze"], "trips")
    if a.command == "bronze":
        said = run_bronze(spark, a.raw_path or paths["raw"], a.bronze_path or bronze, a.start, a.end, registry)
    elif a.command == "silver":
        said = build_silver(spark, bronze, paths["silver"], a.groups, registry, a.force)
    else:
        frames, counts = load_training_data(read_table(spark, table_path(paths["silver"], "trip_features")))
        model, metrics = train_gbt(frames)
        used = list(registry.latest_feature_runs(ORDER).values()) if registry else []
        folder = save_artifact(paths["models"], "sparkml", model, metrics, {"rows": counts, "feature_runs": used})
        if registry:
            registry.register_model_run("sparkml", {}, metrics, folder, used, code_version())
        said = {"artifact": folder, "metrics": metrics, "rows": counts}
    print(json.dumps(said, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
