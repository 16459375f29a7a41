import datetime
import json
import os

import pytest

from lectern.operators.merge import SEQUENCE, last_per_key
from lectern.plans.harvest import harvest, read_source
from lectern.schema import COURSE
from lectern.sources.catalog import CatalogStore
from lectern.sources.feeds import read_coursera_pages, read_edx_csv
from lectern.streaming.sync import sync_available_now

AS_OF = datetime.datetime(2024, 1, 1)
HEADER = "summary,title,course_description,subject,Level,course_url,language,extra\n"


@pytest.fixture()
def edx(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "my_EdX_courses.csv").write_text(
        HEADER
        + 'sum,One,"line 1\nline ""2""",Math,Introductory,http://1,en,x\n'
        + "sum2,Two,,NA,,http://2,,x\n"
        + ",,d,s,l,http://3,fr,x\n"
        + "s,No url,d,s,l,,fr,x\n"
        + "s,One again,,Art,,http://1,fr,x\n"
    )
    (folder / "other.csv").write_text("title\nignored\n")
    return str(folder)


@pytest.fixture()
def pages(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()

    def row(n, **fields):
        return {"row": {"title": f"t{n}", "URL": f"u{n}", "Skills": None, "other": 1} | fields}

    first = [row(1, Skills="sql", Description="", **{"Course Name": "n1"}), row(2, title="")]
    second = [row(1, title="new", Description="d"), row(3, Level="Beginner level")]
    (folder / "p0.json").write_text(json.dumps({"rows": first}) + "\n")
    (folder / "p1.json").write_text(json.dumps({"rows": second}) + "\n")
    (folder / "p2.json").write_text(json.dumps({"rows": []}) + "\n")
    for i in range(3):
        os.utime(folder / f"p{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def test_edx_cells(spark, edx):
    rows = read_edx_csv(spark, edx).orderBy(SEQUENCE).collect()
    assert len(rows) == 5
    assert rows[0].course_description == 'line 1\nline "2"'
    assert (rows[1].subject, rows[1].language, rows[1].title) == ("", "", "Two")


def test_edx_missing_cells_read_like_pandas(spark, edx):
    import pandas as pd

    table = pd.read_csv(f"{edx}/my_EdX_courses.csv").fillna("")
    rows = read_edx_csv(spark, edx).orderBy(SEQUENCE).drop(SEQUENCE).collect()
    for row, (_, cells) in zip(rows, table.iterrows()):
        assert row.asDict() == {k: cells[k] for k in row.asDict()}


def test_harvest_edx(spark, edx):
    empty = spark.createDataFrame([], COURSE)
    got = {r.original_url: r for r in harvest(spark, "EDX", edx, empty, AS_OF).collect()}
    assert set(got) == {"http://1", "http://2"}
    assert got["http://1"].title == "One again"
    assert got["http://1"].description == "s"
    assert got["http://2"].description == "sum2"
    assert got["http://2"].language == "en"
    assert got["http://2"].source_repository == "edX"
    assert got["http://1"].last_updated == AS_OF
    assert got["http://1"].skills is None


def test_harvest_coursera(spark, pages):
    empty = spark.createDataFrame([], COURSE)
    got = {r.original_url: r for r in harvest(spark, "coursera", pages, empty, AS_OF).collect()}
    assert set(got) == {"u1", "u3"}
    assert (got["u1"].title, got["u1"].description) == ("new", "d")
    assert (got["u1"].category, got["u1"].language) == ("General", "en")
    assert got["u3"].level == "Beginner level"
    first = read_coursera_pages(spark, pages).filter("Skills = 'sql'").first()
    assert first["Course Name"] == "n1"


def test_later_feed_keeps_fields_it_does_not_know(spark, edx, pages):
    stored = harvest(spark, "coursera", pages, spark.createDataFrame([], COURSE), AS_OF)
    url = spark.createDataFrame([("u3", "renamed")], "original_url string, title string")
    from lectern.operators.merge import merge_upsert

    row = merge_upsert(stored, url).filter("original_url = 'u3'").first()
    assert (row.title, row.level) == ("renamed", "Beginner level")


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown source"):
        read_source(spark, "udemy", "/nowhere", AS_OF)


def test_bad_page_raises(spark, tmp_path):
    (tmp_path / "x.json").write_text("{broken\n")
    with pytest.raises(Exception):
        read_coursera_pages(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_sync_equals_one_merge(spark, pages, tmp_path, files_per_batch):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    where = str(tmp_path / "checkpoint")
    sync_available_now(spark, "coursera", pages, store, where, AS_OF, files_per_batch)
    want = harvest(spark, "coursera", pages, spark.createDataFrame([], COURSE), AS_OF)
    assert sorted(store.read().collect()) == sorted(want.select(*COURSE.names).collect())
    before = files_of(tmp_path / "catalog")
    sync_available_now(spark, "coursera", pages, store, where, AS_OF, files_per_batch)
    assert files_of(tmp_path / "catalog") == before  # no new files, nothing is rewritten


def files_of(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def page_file(folder, name, *urls):
    rows = [{"row": {"title": f"T {u}", "URL": u, "Description": "d"}} for u in urls]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"rows": rows}))
    return str(folder)


def test_sync_of_two_folders_keeps_both(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    one = page_file(tmp_path / "one", "a.json", "u1")
    two = page_file(tmp_path / "two", "a.json", "u2")
    sync_available_now(spark, "coursera", one, store, str(tmp_path / "a"), AS_OF)
    sync_available_now(spark, "coursera", two, store, str(tmp_path / "b"), AS_OF)
    assert {r.original_url for r in store.read().collect()} == {"u1", "u2"}


def test_sync_after_a_lost_checkpoint_sees_new_files(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    folder = page_file(tmp_path / "one", "a.json", "u1")
    sync_available_now(spark, "coursera", folder, store, str(tmp_path / "a"), AS_OF)
    page_file(tmp_path / "one", "b.json", "u2")
    sync_available_now(spark, "coursera", folder, store, str(tmp_path / "b"), AS_OF)
    want = harvest(spark, "coursera", folder, spark.createDataFrame([], COURSE), AS_OF)
    assert sorted(store.read().collect()) == sorted(want.select(*COURSE.names).collect())


def test_sync_edx(spark, edx, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    sync_available_now(spark, "edx", edx, store, str(tmp_path / "a"), AS_OF)
    assert {r.title for r in store.read().collect()} == {"One again", "Two"}


def test_position_orders_repeats_within_a_file(spark, edx):
    last = last_per_key(read_edx_csv(spark, edx), "course_url")
    assert last.filter("course_url = 'http://1'").first().title == "One again"
