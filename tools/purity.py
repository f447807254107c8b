"""Which calls of the engine could make two runs differ: python tools/purity.py. Functions, operators and matching must have none.

Clocks, randomness without a seed and rows numbered by where they happen to lie are for the edges: sessions, ledgers, seals.
"""

from __future__ import annotations

import ast
import sys
from collections.abc import Iterator
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent / "lexloom"
#: Calls by their last names; of the generators only those without an argument.
FORBIDDEN = {
    "rand", "randn", "random", "shuffle", "uuid", "uuid1", "uuid4", "current_timestamp", "current_date", "now", "today", "utcnow", "time", "monotonically_increasing_id", "getrandbits", "localCheckpoint",
}
UNSEEDED = {"default_rng", "Random", "seed"}
#: Where the clock or a fresh name is the point.
EDGES = {("session.py", "uuid4"), ("operators/holdout.py", "now"), ("operators/ledger.py", "now"), ("llm/term_counts.py", "uuid4")}


def findings(root: Path = ROOT) -> Iterator[tuple[str, int, str]]:
    for path in sorted(root.rglob("*.py")):
        place = path.relative_to(root).as_posix()
        for node in ast.walk(ast.parse(path.read_text(encoding="utf-8"))):
            if isinstance(node, ast.Call):
                name = node.func.attr if isinstance(node.func, ast.Attribute) else getattr(node.func, "id", "")
                if ((name in FORBIDDEN) or (name in UNSEEDED and not node.args)) and (place, name) not in EDGES:
                    yield place, node.lineno, name


if __name__ == "__main__":
    found = list(findings())
    for place, line, name in found:
        print(f"{place}:{line}: {name}")
    sys.exit(bool(found))
