from lectern.operators.cluster import (
    assign_clusters,
    cluster_courses,
    store_clusters,
    with_cluster_text,
)

ROWS = [
    ("1", "sql, data!", "x", 9), ("2", None, "Art & craft", None), ("3", "", "x", None),
    ("4", None, None, None), ("5", "sql data", "x", None), ("6", "été", None, None),
]


def test_cluster_text(spark):
    df = spark.createDataFrame(ROWS, "_id string, skills string, category string, cluster int")
    got = {r._id: r.clustering_text_cleaned for r in with_cluster_text(df).collect()}
    assert got == {"1": "sql data", "2": "Art  craft", "3": "", "4": "", "5": "sql data", "6": "t"}


def test_every_row_gets_a_label(spark):
    df = spark.createDataFrame(
        [(str(i), f"topic{i % 6} skill{i % 4}", "c", 99) for i in range(48)],
        "_id string, skills string, category string, cluster int",
    ).coalesce(2)
    first = cluster_courses(df, k=4, num_features=50)
    assert first.columns == df.columns
    labels = {r._id: r.cluster for r in first.collect()}
    assert len(labels) == 48 and set(labels.values()) <= set(range(4))
    again = {r._id: r.cluster for r in cluster_courses(df, k=4, num_features=50).collect()}
    assert labels == again
    same_text = {}
    for i in range(48):
        same_text.setdefault(i % 12, set()).add(labels[str(i)])
    assert all(len(found) == 1 for found in same_text.values())
    assert "clustering_text_cleaned" in cluster_courses(df, 2, keep_text=True).columns


def test_stored_clusters(spark, tmp_path):
    df = spark.createDataFrame(
        [(f"{i:02}", f"topic{i % 6} skill{i % 4}", "c", 99) for i in range(48)],
        "_id string, skills string, category string, cluster int",
    )
    path = str(tmp_path / "clusters")
    store_clusters(df.filter("_id < '36'"), path, k=4, num_features=50)
    labels = {r._id: r.cluster for r in assign_clusters(spark, df, path).collect()}
    for other in (df.repartition(7), df.coalesce(1), df.orderBy("skills")):
        assert labels == {r._id: r.cluster for r in assign_clusters(spark, other, path).collect()}
    alone = assign_clusters(spark, df.filter("_id = '40'"), path)
    assert alone.columns == df.columns and alone.first().cluster == labels["40"]
    assert all(labels[f"{i:02}"] == labels[f"{i % 12:02}"] for i in range(48))
    # Numbers follow the smallest id of each cluster, without gaps.
    first = {}
    for i in range(36):
        first.setdefault(labels[f"{i:02}"], i)
    assert list(first) == sorted(first) == list(range(len(first)))
    assert assign_clusters(spark, df.limit(0), path).count() == 0
