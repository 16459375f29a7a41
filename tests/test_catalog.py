"""The partitioned catalog, its kept facets, its title index and its page directory."""

import pytest
from pyspark.sql import functions as F

from lectern.operators.facets import category_facet, language_facet
from lectern.operators.merge import merge_upsert
from lectern.schema import COURSE
from lectern.sources import catalog, page_directory, title_index
from lectern.sources.catalog import CatalogStore, read_catalog

FIELDS = "_id string, title string, category string, language string, original_url string"


def courses(spark, ids, category="Math", language="en"):
    rows = [
        (f"{i}", f"Title {i}", category if i % 3 else " ", language if i % 4 else None, f"u{i}")
        for i in ids
    ]
    return spark.createDataFrame(rows, FIELDS)


def files_of(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


@pytest.fixture
def store(spark, tmp_path):
    made = CatalogStore(spark, str(tmp_path / "catalog"), buckets=16)
    assert made.read().count() == 0 and made.category_facet().count() == 0
    assert len(made.upsert(courses(spark, range(200)))) == 16
    return made


def same_facets(store):
    kept = store.category_facet().collect(), store.language_facet().collect()
    counted = category_facet(store.read()).collect(), language_facet(store.read()).collect()
    return kept == counted


def test_only_touched_partitions_are_rewritten(spark, store, tmp_path):
    before = files_of(tmp_path / "catalog")
    batch = courses(spark, [7, 300], "Physics", "fr").drop("_id")
    want = merge_upsert(store.read().select(*COURSE.names), batch).collect()
    touched = store.upsert(batch)
    assert 1 <= len(touched) <= 2
    after = files_of(tmp_path / "catalog")
    changed = {f.split("/")[1] for f in before ^ after}
    assert changed == {f"bucket={b}" for b in touched}
    assert sorted(store.read().collect()) == sorted(want)
    assert store.read().filter("original_url = 'u7'").first().category == "Physics"


def test_kept_facets_equal_a_recount(spark, store):
    assert same_facets(store)
    batch = courses(spark, range(150, 260), "Physics", "fr")
    store.upsert(batch)
    assert same_facets(store)
    counts = store.facet_counts("category").collect()
    store.upsert(batch)  # a replay
    assert same_facets(store) and sorted(store.facet_counts("category").collect()) == sorted(counts)
    assert store.read().count() == 260


def test_a_batch_without_rows_changes_nothing(spark, store, tmp_path):
    before = files_of(tmp_path / "catalog")
    assert store.upsert(courses(spark, range(3)).limit(0)) == []
    assert files_of(tmp_path / "catalog") == before


def test_a_replay_repairs_lost_facets(spark, store, tmp_path):
    batch = courses(spark, [1, 2, 3], "Physics")
    touched = store.upsert(batch)
    for path in (tmp_path / "catalog" / "facets" / f"bucket={touched[0]}").glob("*.parquet"):
        path.unlink()  # as if the writer had ended before its second table
    assert not same_facets(store)
    store.upsert(batch)
    assert same_facets(store)


def test_reading_some_partitions_only(spark, store, capsys):
    store._stored("courses", COURSE).filter(F.col("bucket").isin([3])).explain("formatted")
    assert "PartitionFilters: [isnotnull(bucket" in capsys.readouterr().out


# Title index

TITLES = [
    "Spark for All", "spark", "Sparse park", "ARK", "r", "", None, "Été à Paris", "C++ & C",
    "İstanbul", "北京 Spark", "a\nb", "park ark spar", "x" * 3000 + "needle", "%_", "rk",
    "\U0001F600 smile",
]


@pytest.fixture(scope="module")
def titled(spark, tmp_path_factory):
    rows = [(f"{i:03d}", t) for i, t in enumerate(TITLES * 3)]
    table = spark.createDataFrame(rows, "_id string, title string")
    path = str(tmp_path_factory.mktemp("index") / "titles")
    title_index.build_title_index(table, path)
    return table, path


@pytest.mark.parametrize(
    "word",
    ["spark", "ARK", "rk", "r", "park ark", "é", "ÉTÉ", "c++", "+", "nowhere", "needle", "\n",
     "%_", "北京", "京 s", "le", "\U0001F600", "all", ""],
)
@pytest.mark.parametrize("pushed", [1_000, 2])
def test_index_finds_what_a_scan_finds(titled, monkeypatch, word, pushed):
    table, path = titled
    monkeypatch.setattr(title_index, "PUSHED_IDS", pushed)
    got = title_index.search_titles(table, path, word)
    want = table.filter(F.lower("title").contains(word.lower())) if word else table
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_index_filters_reach_the_scan(spark, titled, capsys):
    table, path = titled
    for word, pushed in (("spark", "In(gram, [ark,par,spa])"), ("rk", "StringStartsWith(gram,rk)")):
        title_index.candidates(spark, path, word).explain("formatted")
        assert pushed in capsys.readouterr().out


def test_tasks_sort_so_many_grams_and_bytes_however_large_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(title_index, "TASK_CHARS", 4_000, raising=False)
    table = spark.range(2000).selectExpr("format_string('%04d', id) AS _id", "concat('title ', id) AS title")
    title_index.build_title_index(table, str(tmp_path / "titles"))
    index = spark.read.parquet(str(tmp_path / "titles"))
    per_file = [r["count"] for r in index.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == table.select(F.explode(title_index.grams(F.col("title")))).count()
    assert max(per_file) <= 2 * 4_000 < sum(per_file)

    monkeypatch.setattr(catalog, "TASK_BYTES", 4_000, raising=False)
    placed = catalog.sorted_by(table.orderBy(F.desc("_id")), "_id")
    parts = [[r._id for r in part] for part in placed.rdd.glom().collect()]
    assert [i for part in parts for i in part] == [f"{i:04d}" for i in range(2000)]
    assert max(map(len, parts)) <= 2 * 2000 / 7 and len(parts) == 7


# Page directory


@pytest.mark.parametrize("file_rows", [7, 10_000])
def test_pages_by_directory_equal_offsets(spark, tmp_path, file_rows):
    rows = [(f"{i % 90:03d}", i) for i in range(100)] + [(None, 1), (None, 2)]
    table = spark.createDataFrame(rows, "_id string, n int").repartition(5)
    page_directory.write_sorted(table, str(tmp_path), file_rows=file_rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for page in (1, 2, 5, 6, 7, "3", None):
        at = (int(page or 1) - 1) * 18
        got = page_directory.page_at(spark, str(tmp_path), table.schema, page)
        assert list(map(tuple, got.collect())) == ordered[at : at + 18]
    with pytest.raises(ValueError):
        page_directory.page_at(spark, str(tmp_path), table.schema, -1)


def test_a_deep_page_opens_few_files(spark, tmp_path):
    table = spark.range(1000).selectExpr("format_string('%04d', id) AS _id", "id")
    page_directory.write_sorted(table, str(tmp_path), file_rows=20)
    assert page_directory.directory(spark, str(tmp_path)).count() >= 50
    for page in (1, 20, 55):
        got = page_directory.page_at(spark, str(tmp_path), table.schema, page)
        assert len(got.inputFiles()) <= 2


def test_pages_of_an_empty_table(spark, tmp_path):
    table = spark.createDataFrame([], "_id string, n int")
    page_directory.write_sorted(table, str(tmp_path))
    assert page_directory.page_at(spark, str(tmp_path), table.schema).count() == 0
    assert read_catalog(spark, f"{tmp_path}/rows", table.schema).count() == 0
