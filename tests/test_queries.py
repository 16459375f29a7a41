"""Every registered query against its SQL twin on the smallest tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
SLOW = {
    "lsh_recall", "similar_pairs_lsh", "top5_similar_lsh", "cluster_courses", "clusters_assigned",
}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows):
    shown = [
        tuple("~" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)
        for row in rows
    ]
    return sorted(shown)


def test_only_what_sql_cannot_say_has_no_twin():
    assert set(entry.own_queries()) - set(entry.own_oracle_sql()) == SLOW


@pytest.mark.parametrize("name", sorted(entry.own_oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    rows = [tuple(row[i] for i in at) for row in want.fetchall()]
    assert canonical(got.select(*columns).collect()) == canonical(rows)


@pytest.mark.parametrize("name", sorted(SLOW))
def test_other_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", ["filter_category", "filter_language", "course_by_id"])
def test_filters_reach_the_stored_catalog(spark, capsys, name):
    entry.queries()[name](spark, SF_DIR).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x]
    assert any("EqualTo" in x for x in pushed)


def test_bucketed_lookups_read_their_buckets(spark, capsys):
    courses = entry._bucketed(spark, SF_DIR, "courses")
    assert len(courses.inputFiles()) > 40
    found = courses.filter("_id = '104'")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # is shown then
    found.explain("formatted")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 64" in capsys.readouterr().out
    assert found.count() == 1


def test_suggestions_do_not_shuffle_bucketed_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entry.suggestions_bucketed(spark, SF_DIR)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The exchanges are those of the best per user: by what is suggested, then by user.
    assert "hashpartitioning(_id" not in plan and "SortMergeJoin [_id" in plan


def test_entry(spark):
    assert entry.entry(spark).columns == ["_id", "rank", "similar_doc_id", "score"]
