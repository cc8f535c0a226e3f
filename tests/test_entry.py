import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_core_does_not_import_the_optional_part():
    for path in (ROOT / "folium").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "folium").parts:
            text = path.read_text(encoding="utf-8")
            assert "folium.llm" not in text and "from .llm" not in text, path
