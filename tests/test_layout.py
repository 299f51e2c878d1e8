from __future__ import annotations

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def imports(path: Path) -> set[str]:
    found: set[str] = set()
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.Import):
            found |= {a.name for a in node.names}
        elif isinstance(node, ast.ImportFrom):
            found.add(node.module or "")
    return found


def test_only_the_entry_imports_the_corpus_operators():
    for path in [*(ROOT / "sunframe").rglob("*.py"), *(ROOT / "tests").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert not any(m.startswith(("sunframe.llm", "corpus_pipeline")) for m in imports(path)), path


def test_nothing_uses_local_checkpoints_or_cross_joins():
    for path in (ROOT / "sunframe").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint(" not in text and "crossJoin(" not in text, path
