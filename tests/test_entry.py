import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_jars_or_session(tmp_path):
    """A fresh process, elsewhere, in which no Spark jar can be listed."""
    code = (
        f"import sys, glob; sys.path.insert(0, {ROOT!r}); glob.glob = lambda *a, **k: [];"
        "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql();"
        "assert len(q) >= 46 and len(o) >= 44 and set(o) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_entry_works_without_the_optional_folders(tmp_path):
    for name in ("acervo", "checks"):
        for folder, _, files in os.walk(os.path.join(ROOT, name)):
            if "llm" in folder.split(os.sep) or "__pycache__" in folder:
                continue
            target = tmp_path / os.path.relpath(folder, ROOT)
            target.mkdir(parents=True, exist_ok=True)
            for file in files:
                (target / file).write_bytes(open(os.path.join(folder, file), "rb").read())
    (tmp_path / "__spark_entry__.py").write_bytes(open(os.path.join(ROOT, "__spark_entry__.py"), "rb").read())
    code = "import __spark_entry__ as e; assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
