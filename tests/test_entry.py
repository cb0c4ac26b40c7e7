"""The driver contract: entry(), queries(), oracle_sql()."""

from __future__ import annotations

import importlib.util
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_the_smallest_tables(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment", "customers", "average_recency", "average_frequency",
                          "average_monetary", "total_monetary", "value_share"]


def test_queries_and_oracles_share_keys():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    assert len(q) >= 100
    assert set(o) <= set(q)
    assert all(sql.lstrip().upper().startswith(("WITH", "SELECT", "(")) for sql in o.values())


def test_no_library_query_uses_reserved_names():
    from tillroll.registry import spark_queries
    assert not [k for k in spark_queries() if k == "pipeline" or (k.startswith("op") and k[2:3].isdigit())]


def test_the_library_stands_without_the_training_data_part():
    # the entry module and everything below it import with that part out of reach
    code = ("import sys; sys.modules['tillroll.llm'] = None\n"
            "import importlib.util as u; s = u.spec_from_file_location('e', '__spark_entry__.py'); m = u.module_from_spec(s)\n"
            "s.loader.exec_module(m); print(len(m.queries()), len(m.oracle_sql()), any('.llm' in n for n in sys.modules if sys.modules[n]))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 100 and int(out[1]) >= 100 and out[2] == "False"
