"""The subpackage can be left out, and nothing else imports it."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[2]


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("rentloom/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "rentloom.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path


def test_entry_point_imports_without_it(tmp_path):
    for path in [ROOT / "__spark_entry__.py", *ROOT.glob("rentloom/**/*.py")]:
        rest = path.relative_to(ROOT)
        if "llm" not in rest.parts:
            (tmp_path / rest).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / rest).write_text(path.read_text())
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()))"
    for left in (False, True):
        if left:  # a folder that is still there but empty
            (tmp_path / "rentloom/llm").mkdir()
            (tmp_path / "corpus_pipeline.py").write_text((ROOT / "corpus_pipeline.py").read_text())
        run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert run.stdout.strip() == "True", run.stderr
