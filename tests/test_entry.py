"""The entry module with and without the optional training-data package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(prelude: str) -> set[str]:
    code = f"import sys\n{prelude}\nimport __spark_entry__ as e\nprint(*e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    return set(subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split())


def test_without_the_package_the_other_queries_stay():
    from flowlens.plans.registry import QUERIES

    absent = "".join(f"sys.modules['{m}'] = None\n" for m in ("flowlens.llm", "corpus_pipeline"))
    assert names(absent) == set(QUERIES)


def test_other_import_errors_are_not_hidden():
    code = "import sys\nsys.modules['numpy'] = None\nimport __spark_entry__"
    if not os.path.isdir(os.path.join(ROOT, "flowlens", "llm")):
        return
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode != 0
