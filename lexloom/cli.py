"""python -m lexloom.cli check-corpus [--artifacts DIR] [--holdout DIR]; python -m lexloom.cli inventory-lock check|update [--root DIR]."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from lexloom.config import require_artifacts_dir, resolve
from lexloom.errors import CorpusConfigError, HoldoutSealError
from lexloom.operators import inventory
from lexloom.types import CorpusPaths


def check_corpus(paths: CorpusPaths, providers=None) -> int:
    """0 if all artifacts pass all guards (or there are none), else 1, every problem printed. A malformed artifact raises."""
    from lexloom.operators import artifact, licensing
    from lexloom.operators.holdout import load_holdout
    from lexloom.session import session
    from lexloom.sources.registry_csv import KNOWN_PROVIDERS

    try:
        require_artifacts_dir(paths)
        sealed = load_holdout(paths.holdout)
    except (CorpusConfigError, HoldoutSealError) as problem:
        print(problem)
        return 1
    files = sorted(paths.artifacts.glob("*.json"))
    if not files:
        print("no artifacts")
        return 0
    spark = session("check-corpus")
    artifacts = artifact.read_json(spark, f"{paths.artifacts}/*.json")
    known = licensing.descriptors_frame(spark, (providers or KNOWN_PROVIDERS).values())
    names = spark.createDataFrame([(n,) for n in sealed[0]], "normalized string") if sealed else None
    problems = artifact.check(artifacts, known, names).orderBy("artifact_id", "violation", "detail").toLocalIterator()
    found = 0
    for row in problems:
        found += 1
        print(f"{row['artifact_id']}: {row['violation']}: {row['detail']}")
    print(f"{len(files)} artifacts, {found} problems")
    return int(found > 0)


def inventory_check(root: Path) -> int:
    """1 if any inventory under ``root`` has no lock or breaks it; a missing root passes."""
    from lexloom.session import session

    bad, found = 0, inventory.discover(root)
    spark = session("inventory-lock") if found else None
    for path in found:
        lock = inventory.load_lock(inventory.lock_path_for(path))
        if lock is None:
            print(f"{path}: not locked")
            bad += 1
            continue
        for violation in inventory.compare(spark, path, inventory.load_entries(path), lock):
            print(violation)
            bad += 1
    return int(bad > 0)


def inventory_update(root: Path) -> int:
    for path in inventory.discover(root):
        inventory.lock_path_for(path).write_text(json.dumps(inventory.build_lock(inventory.load_entries(path)), indent=2) + "\n", encoding="utf-8")
        print(f"{path}: locked")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexloom")
    commands = parser.add_subparsers(dest="command", required=True)
    corpus = commands.add_parser("check-corpus")
    corpus.add_argument("--artifacts", type=Path)
    corpus.add_argument("--holdout", type=Path)
    lock = commands.add_parser("inventory-lock")
    lock.add_argument("action", choices=("check", "update"))
    lock.add_argument("--root", type=Path, default=Path("data/inventory"))
    args = parser.parse_args(argv)
    if args.command == "inventory-lock":
        return (inventory_check if args.action == "check" else inventory_update)(args.root)
    paths = resolve(Path.cwd())
    return check_corpus(CorpusPaths(args.artifacts or paths.artifacts, args.holdout or paths.holdout))


if __name__ == "__main__":
    raise SystemExit(main())
