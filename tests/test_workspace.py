"""A workspace reopened on the same root finds its tables, versions and flows."""

from strata.plans.common import ingest_lines, line_files, setup
from strata.plans.workspace import Workspace


def test_reopen_restores_catalog_and_continues(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        ws.materialized_view("m", t.part)
        ws.materialized_view("m", t.part)
    n = ws.read("b_orders").count()
    again = Workspace(spark, root=ws.root, pipeline_id=ws.pipeline_id)
    assert again.catalog["m"].version == 2
    assert again.catalog["b_orders"].flows == ["b_orders"]
    assert again.read("b_orders").count() == n
    with again.update():
        ingest_lines(again, path)  # nothing new: the checkpoint remembers the files
    assert again.read("b_orders").count() == n


def test_vacuum_keeps_current_version(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    for _ in range(3):
        ws.materialized_view("m", t.part)
    gone = ws.vacuum("m", keep=1)
    assert len(gone) == 2
    assert ws.read("m").count() == t.part.count()
