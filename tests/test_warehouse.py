"""Stored tables: whole or absent, never half read; a cluster needs a shared folder."""

from __future__ import annotations

import os
import uuid

import pytest

from tillroll import session
from tillroll.plans import warehouse as W
from tests.conftest import SF_SMALL


def _fresh(spark):
    return W.Warehouse(spark, SF_SMALL, root=os.path.join(session.checkpoint_dir(spark), "tillroll-test", uuid.uuid4().hex))


def test_a_leftover_of_an_interrupted_build_is_not_read(spark):
    first = _fresh(spark)
    rows = first.table("bronze").count()
    broken = _fresh(spark)
    # part of the rows, in folders as an interrupted build would leave them
    for name in ("bronze", f"bronze-{uuid.uuid4().hex[:12]}"):
        first.table("bronze").limit(100).write.parquet(os.path.join(broken.root, name))
    assert broken.table("bronze").count() == rows


def test_a_pointer_that_cannot_be_written_raises(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    with pytest.raises(Exception):
        session.write_pointer(spark, str(blocked / "bronze.current"), "somewhere")


def test_a_second_warehouse_reuses_whole_tables(spark):
    a = _fresh(spark)
    a.table("bronze")
    b = W.Warehouse(spark, SF_SMALL, root=a.root)
    assert b.table("bronze").inputFiles() == a.table("bronze").inputFiles()


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_old_versions_are_dropped_and_others_stay(spark):
    current = W.Warehouse.for_source(spark, SF_SMALL)
    current.table("bronze")
    base = os.path.dirname(current.root)
    name = os.path.basename(current.root)
    old = "-".join([*name.split("-")[:-1], "0" * 12])
    for other in (old, "unrelated-folder"):
        os.makedirs(os.path.join(base, other), exist_ok=True)
    assert old in W.drop_old_versions(spark, SF_SMALL)
    left = session.list_folders(spark, base)
    assert name in left and "unrelated-folder" in left and old not in left


def test_categories_from_a_file(spark, tmp_path):
    with open(tmp_path / "categories.csv", "w") as fh:
        fh.write("stock_code,category\nPOST,freight\n")
    root = os.path.join(session.checkpoint_dir(spark), "tillroll-test", uuid.uuid4().hex)
    wh = W.Warehouse(spark, SF_SMALL, root=root, categories_path=str(tmp_path / "categories.csv"))
    silver = wh.table("silver_transactions")
    assert {r["line_category"] for r in silver.select("line_category").distinct().collect()} == {"product", "freight"}
    assert silver.where("is_special_stockcode and StockCode <> 'POST'").count() == 0
    # without a root of its own, it doesn't share the tables of the built-in categories
    assert W.Warehouse(spark, SF_SMALL, categories_path=str(tmp_path / "categories.csv")).root != W.Warehouse(spark, SF_SMALL).root
