import datetime
import json

import pytest
from pyspark.sql import Observation

from lectern.plans.harvest import harvest
from lectern.schema import COURSE
from lectern.sources.catalog import CatalogStore
from lectern.sources.paged import SavedPages, read_pages, stream_pages
from lectern.streaming.sync import sync_available_now

AS_OF = datetime.datetime(2024, 1, 1)


def save(folder, page, rows, length=3):
    where = folder / f"offset={page * length}"
    where.mkdir(parents=True, exist_ok=True)
    cells = [{"row": {"title": f"T {u}", "URL": u, "Description": "d"}} for u in rows]
    (where / "part.json").write_text(json.dumps({"rows": cells}) + "\n")


def urls(frame):
    return [(r.page, r.pos, r.row.URL) for r in frame.orderBy("page", "pos").collect()]


@pytest.mark.parametrize("pages", [0, 1, 2, 3, 4, 7, 8, 9, 31])
def test_end_is_the_first_empty_page(tmp_path, pages):
    for p in range(pages):
        save(tmp_path, p, ["u"])
    save(tmp_path, pages, [])
    saved = SavedPages({"path": str(tmp_path), "length": "3"})
    assert saved.end() == pages
    assert all(saved.end(known) == pages for known in range(pages + 1))


def test_a_partition_per_page(spark, tmp_path):
    for p in range(5):
        save(tmp_path, p, [f"u{p}a", f"u{p}b", None])
    found = read_pages(spark, str(tmp_path), length=3)
    assert found.rdd.getNumPartitions() == 5
    want = [(p, i, u) for p in range(5) for i, u in enumerate((f"u{p}a", f"u{p}b", None))]
    assert urls(found) == want
    assert urls(read_pages(spark, tmp_path.as_uri(), length=3)) == want
    assert urls(read_pages(spark, str(tmp_path / "none"), length=3)) == []


def test_planning_asks_for_few_pages(tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(
        SavedPages, "rows", lambda self, page: asked.append(page) or [{}] * (page < 100_000)
    )
    assert SavedPages({"path": str(tmp_path)}).end() == 100_000
    assert len(asked) < 40


@pytest.mark.parametrize("text", ["{broken", "[]", '{"rows": 1}', '{"rows": [{}]}', '{"x": []}'])
def test_bad_page_raises(spark, tmp_path, text):
    save(tmp_path, 0, ["u"])
    (tmp_path / "offset=0" / "part.json").write_text(text)
    with pytest.raises(Exception, match="not a page of rows"):
        read_pages(spark, str(tmp_path), length=3).collect()


def test_cells_that_are_no_text(spark, tmp_path):
    save(tmp_path, 0, [5, {"a": [1]}, "x", ""])
    found = read_pages(spark, str(tmp_path), length=3)
    assert [u for _, _, u in urls(found)] == ["5", '{"a":[1]}', "x", ""]


@pytest.mark.parametrize("most", [None, 1, 2])
def test_stream_goes_on_within_a_page(spark, tmp_path, most):
    folder, checkpoint, out = (str(tmp_path / n) for n in ("feed", "checkpoint", "out"))

    def run():
        query = (
            stream_pages(spark, folder, length=3, max_pages=most)
            .writeStream.format("parquet")
            .options(checkpointLocation=checkpoint, path=out)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return urls(spark.read.parquet(out))

    save(tmp_path / "feed", 0, ["a", "b", "c"])
    save(tmp_path / "feed", 1, ["d"])
    seen = run()
    for _ in range(3):  # a run takes up to ``most`` pages
        seen = run()
    assert seen == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "d")]
    save(tmp_path / "feed", 1, ["d", "e", "f"])
    save(tmp_path / "feed", 2, ["g"])
    for _ in range(3):
        seen = run()
    assert seen[3:] == [(1, 0, "d"), (1, 1, "e"), (1, 2, "f"), (2, 0, "g")]
    assert run() == seen


def test_harvest_counts_what_it_accepts(spark, tmp_path):
    for p, found in enumerate((["a"] * 100, ["b", "", None, "a"])):
        save(tmp_path, p, found, length=100)
    counts = Observation()
    empty = spark.createDataFrame([], COURSE)
    got = harvest(spark, "coursera-paged", str(tmp_path), empty, AS_OF, observed=counts)
    assert {r.original_url for r in got.collect()} == {"a", "b"}
    assert counts.get == {"accepted": 102}


def test_sync_of_a_paged_feed(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    folder, checkpoint = tmp_path / "feed", str(tmp_path / "checkpoint")
    save(folder, 0, [f"u{i}" for i in range(100)], length=100)
    save(folder, 1, ["u0", "v"], length=100)
    sync_available_now(spark, "coursera-paged", str(folder), store, checkpoint, AS_OF)
    assert store.read().count() == 101
    save(folder, 1, ["u0", "v", "w"], length=100)
    sync_available_now(spark, "coursera-paged", str(folder), store, checkpoint, AS_OF)
    assert store.read().count() == 102
