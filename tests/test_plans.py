"""Plan properties of every registered query (on the smallest tables): no cartesian
product, no nested-loop join and no Python UDF in the physical plan."""

import contextlib
import io
import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def names():
    """The queries of this library proper; the optional packages test their own."""
    return {n for n in entry.queries() if not re.match(r"op[0-9]+_|pipeline$", n)}


def test_no_registered_query_plans_pairs_or_python(spark):
    bad = {}
    for name, query in entry.queries().items():
        if name not in names():
            continue
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            query(spark, SF).explain()
        hits = [op for op in FORBIDDEN if op in out.getvalue()]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_every_registered_query_has_an_oracle():
    assert names() <= set(entry.oracle_sql())


def test_without_the_optional_packages(tmp_path):
    """The entry module imports and registers its own queries when the subpackage is not
    there, whether or not the pipeline's file still is."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "ledgerflow", tmp_path / "ledgerflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for pipeline in (False, True):
        if pipeline:
            (tmp_path / "corpus_pipeline.py").write_text("from ledgerflow.llm import quality\n")
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
        assert out.stdout.split() == [str(len(names())), "True"], out.stderr
