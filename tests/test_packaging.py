"""Workers that do not have the repository on their path."""

import os
import subprocess
import sys
import tomllib

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pactum.session import local_session
spark = local_session(2)
print("ROWS", entry.queries()["token_embedding_join"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_get_the_package(tmp_path):
    """From another folder and without PYTHONPATH a worker finds the package only because it was sent."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]


def test_package_names_its_data_and_modules():
    with open(os.path.join(ROOT, "pyproject.toml"), "rb") as f:
        project = tomllib.load(f)
    assert project["tool"]["setuptools"]["package-data"]["pactum"] == ["data/*.txt"]
    folders = {os.path.relpath(d, ROOT).replace(os.sep, ".") for d, _, names in os.walk(os.path.join(ROOT, "pactum"))
               if any(n.endswith(".py") for n in names) and "__pycache__" not in d}
    missing = [f for f in folders if not os.path.exists(os.path.join(ROOT, f.replace(".", os.sep), "__init__.py"))]
    assert not missing
