import importlib
import subprocess
import sys

import __spark_entry__ as entry


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"runner_ip", "recommended_action", "events", "strongest"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 130


def test_the_rest_works_without_the_corpus_operators():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('millrace.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 130 and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(importlib.import_module("pathlib").Path(entry.__file__).parent))


def test_another_missing_module_is_not_hidden():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'millrace.plans.views': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=str(importlib.import_module("pathlib").Path(entry.__file__).parent), stderr=subprocess.DEVNULL)
    assert run.returncode != 0
