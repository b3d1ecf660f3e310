"""Line form and spread form of landed documents in one folder."""

from __future__ import annotations

import json
from pathlib import Path

from tests.landing import item, land, record

from tierkeep.plans.silver import landing_path, run_silver
from tierkeep.sources.batches import FILE, UNREADABLE, landed_rows, read_documents, spread_files
from tierkeep.sources.schemas import store_core_ddl
from tierkeep.sources.tables import read

AT = "2024-01-01T10:00:00"


def store(*ids):
    return [record(f"b{ids[0]}", "store_api", i, AT, item(i, 100 * i)) for i in ids]


def lay_down(root):
    """Lines, two lines in a file, a spread document, a truncated one, a cut line beside a whole one, JSON without records."""
    folder = Path(landing_path(str(root), "store")) / "date=2024-01-01"
    land(root, "store", "2024-01-01", "lines", store(1, 2))
    land(root, "store", "2024-01-01", "spread", store(3, 4), pretty=True)
    land(root, "store", "2024-01-02", "later", store(5), pretty=True)
    two = "\n".join(json.dumps({"batch_id": str(i), "source": "store_api", "records": store(i)}) for i in (6, 7))
    (folder / "batch_two.json").write_text(two + "\n\n")
    (folder / "batch_cut.json").write_text((folder / "batch_spread.json").read_text()[:-40])
    (folder / "batch_beside.json").write_text(json.dumps({"batch_id": "8", "records": store(8)}) + '\n{"batch_id": "9", "rec')
    (folder / "batch_other.json").write_text('{"a": 1}\n{"b": 2}\n')
    return folder


def test_both_forms_in_one_folder(spark, tmp_path):
    lay_down(tmp_path)
    path = landing_path(str(tmp_path), "store")
    spread = [name.rsplit("/", 1)[1] for name in spread_files(spark, path, store_core_ddl())]
    assert spread == ["batch_cut.json", "batch_spread.json", "batch_later.json"]
    rows = landed_rows(read_documents(spark, path, store_core_ddl())).collect()
    assert sorted(r.request_params.app_id for r in rows if r[UNREADABLE] is None) == [1, 2, 3, 4, 5, 6, 7, 8]
    bad = sorted((r[FILE].rsplit("/", 1)[1], r[UNREADABLE][:1]) for r in rows if r[UNREADABLE] is not None)
    assert bad == [("batch_beside.json", "{"), ("batch_cut.json", "{"), ("batch_other.json", ""), ("batch_other.json", "")]
    late = landed_rows(read_documents(spark, path, store_core_ddl(), since="2024-01-02")).collect()
    assert [r.request_params.app_id for r in late] == [5]


def test_lines_alone_are_not_asked_about(spark, tmp_path):
    land(tmp_path, "store", "2024-01-01", "lines", store(1, 2))
    path = landing_path(str(tmp_path), "store")
    assert spread_files(spark, path, store_core_ddl()) == []
    assert landed_rows(read_documents(spark, path, store_core_ddl())).count() == 2


def test_a_run_over_both_forms_accounts_for_all(spark, tmp_path):
    lay_down(tmp_path)
    row = run_silver(spark, str(tmp_path), str(tmp_path / "silver"), as_of="2024-01-03", include=("items",)).first()
    assert row.success and (row.inserted, row.rejected) == (8, 4)
    assert read(spark, str(tmp_path / "silver" / "rejected" / "dim_games"), None).count() == 4
