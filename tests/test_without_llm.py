import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

CODE = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("spectrine.llm") or name == "corpus_pipeline":
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = set(e.queries())
assert "snv" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
assert set(e.oracle_sql()) <= names
"""


def test_the_rest_stands_alone():
    subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, check=True, timeout=120)
    for path in (ROOT / "spectrine").rglob("*.py"):
        if "llm" not in path.parts:
            assert "spectrine.llm" not in path.read_text() and ".llm" not in path.read_text(), path
