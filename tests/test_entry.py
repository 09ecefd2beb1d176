import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from conftest import SF_SMALL

from tillroll.plans import registry


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["receta", "fecha_extraccion", "costo_total", "porciones", "costo_por_porcion",
                          "comentarios"]


def test_every_query_has_oracle_and_runs(spark):
    qs, sql = registry.queries(), registry.oracle_sql()
    assert set(qs) == set(sql)
    assert set(qs) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
    for name, fn in qs.items():
        df = fn(spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        assert len(df.columns) == len(set(df.columns)), name
        plan = df._jdf.queryExecution().executedPlan().toString()
        # no nested-loop / cartesian joins, no sort-based aggregation, no Python rows
        for bad in ("NestedLoop", "Cartesian", "SortAggregate", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_entry_without_the_optional_parts(scratch):
    """A copy without the training-data subpackage still imports and offers
    every other query; so does one whose optional packages are not installed."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    bare = f"{scratch}/bare"
    shutil.copytree(root, bare, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "*.md"))
    names = "import __spark_entry__ as E, json; print(json.dumps(sorted(E.queries()))); print(json.dumps(sorted(E.oracle_sql())))"
    want = f"{sorted(registry.queries())}\n{sorted(registry.oracle_sql())}\n".replace("'", '"')
    for folder, before in ((bare, ""), (root, "import sys; sys.modules['public_tokenizers'] = None; ")):
        done = subprocess.run([sys.executable, "-c", before + names], cwd=folder, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        assert done.stdout == want
