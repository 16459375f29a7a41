"""

Queries that are not expressible in SQL (random projections, k-means) have no twin.
"""

from __future__ import annotations

import datetime
import importlib
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern import testdata_views as V
from lectern.functions import normalize as N
from lectern.functions.text import highlight
from lectern.functions.vocabulary import LANGUAGE_GROUPS, STOP_WORDS
from lectern.operators import facets, merge
from lectern.operators.cluster import (
    assign_clusters,
    cluster_courses,
    store_clusters,
    with_cluster_text,
)
from lectern.operators.features import item_weights
from lectern.operators.filters import CourseFilter, apply_filter, with_filter_columns
from lectern.operators.paging import clamp_page, page_count
from lectern.plans.cards import course_cards, course_details
from lectern.plans.harvest import harvest
from lectern.plans.listing import course_by_id, list_courses
from lectern.plans.neighbour_store import (
    build_neighbours,
    stored_similarity,
    update_neighbours,
)
from lectern.plans.similar import (
    find_similar,
    lsh_recall,
    neighbours,
    similar_courses,
    similar_courses_by_key,
    similar_text_pairs,
    text_members,
)
from lectern.plans.suggest import suggest_for_all
from lectern.schema import COURSE
from lectern.scratch import scratch_path, stage
from lectern.sources import feeds
from lectern.sources.bucketed import bucketed
from lectern.sources.catalog import CatalogStore, sorted_by
from lectern.sources.page_directory import page_at, write_sorted
from lectern.sources.title_index import build_title_index, search_titles
from lectern.streaming.sync import sync_available_now



def _if_there(module: str, *absent: str) -> ModuleType | None:
    """``module``, or None if it or one of ``absent`` was taken out of the repository."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as missing:
        if missing.name not in (module, *absent):
            raise
        return None


llm = _if_there("lectern.llm.queries", "lectern.llm")
pipeline = _if_there("corpus_pipeline") if llm else None

AS_OF = datetime.datetime(2024, 1, 1)
COURSE_ID = "104"
USER_ID = 7
SEARCH = "the"
INDEXED = "THAT "
DEEP_PAGE = 11
CATALOG_COLUMNS = (
    "_id",
    "title",
    "description",
    "category",
    "skills",
    "level",
    "original_url",
    "source_repository",
    "language",
    "cluster",
)

Query = Callable[[SparkSession, str], DataFrame]
_stored: dict[tuple[str, str], DataFrame] = {}


def _similarity(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The stored neighbour table that lookups and suggestions read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if rebuild or key not in _stored:
        _stored[key] = stage(find_similar(V.courses(spark, sf_dir)), "similarity")
    return _stored[key]


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The courses as a stored catalog, with its filter columns and sorted by id."""
    key = (spark.sparkContext.applicationId, f"catalog of {sf_dir}")
    if key not in _stored:
        courses = with_filter_columns(V.courses(spark, sf_dir))
        _stored[key] = stage(sorted_by(courses, "_id"), "catalog")
    return _stored[key]


def _empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COURSE)


# Queries, in the order of the build plan.


def norm_language(spark, sf_dir):
    c = V.courses(spark, sf_dir)
    return c.select("_id", N.language_name(F.col("language")).alias("language_name"))


def norm_language_display(spark, sf_dir):
    c = V.courses(spark, sf_dir)
    return c.select(
        "_id",
        N.language_label(F.col("language")).alias("label"),
        N.language_detail(F.col("language")).alias("detail"),
    )


def norm_level(spark, sf_dir):
    c = V.courses(spark, sf_dir)
    return c.select(
        "_id",
        N.level_label(F.col("level")).alias("label"),
        N.level_detail(F.col("level")).alias("detail"),
    )


def course_card(spark, sf_dir):
    return course_cards(V.courses(spark, sf_dir), SEARCH)


def course_detail(spark, sf_dir):
    return course_details(V.courses(spark, sf_dir))


def list_page(spark, sf_dir):
    found = list_courses(
        V.courses(spark, sf_dir), language="English", search=SEARCH, page=2
    )
    return found.data.select("_id", "title", "category", "level", "language")


def list_count(spark, sf_dir):
    found = list_courses(_catalog(spark, sf_dir), category="src3", page=3)
    return found.data.agg(F.count(F.lit(1)).alias("count"))


def list_total(spark, sf_dir):
    return list_courses(
        V.courses(spark, sf_dir), language="English", level="Beginner", search=SEARCH
    ).total


def _ids(**wanted: str) -> Query:
    def run(spark, sf_dir):
        return apply_filter(_catalog(spark, sf_dir), CourseFilter(**wanted)).select("_id")

    return run


def highlight_title(spark, sf_dir):
    c = V.courses(spark, sf_dir)
    return c.select("_id", highlight(F.col("title"), SEARCH).alias("title"))


def lookup_course(spark, sf_dir):
    return course_by_id(_catalog(spark, sf_dir), COURSE_ID).select("_id", "title", "level")


def page_numbers(spark, sf_dir):
    pages = page_count(F.col("n"))
    return facets.category_counts(V.courses(spark, sf_dir)).select(
        "category",
        "n",
        pages.alias("pages"),
        clamp_page(F.col("n"), pages).alias("last_page"),
        clamp_page(F.col("category"), pages).alias("first_page"),
    )


def category_counts(spark, sf_dir):
    return facets.category_counts(V.courses(spark, sf_dir))


def facet_categories(spark, sf_dir):
    return facets.category_facet(V.part_catalog(spark, sf_dir))


def facet_languages(spark, sf_dir):
    return facets.language_facet(V.courses(spark, sf_dir))


def ingest_edx(spark, sf_dir):
    folder = V.written_edx_feed(spark, sf_dir)
    # Spark chooses the names of the files it writes, so all CSV files are read here.
    merged = harvest(spark, "edx", folder, _empty_catalog(spark), AS_OF, pattern="*.csv")
    return merged.select(*CATALOG_COLUMNS)


def ingest_coursera(spark, sf_dir):
    folder = V.written_coursera_feed(spark, sf_dir)
    merged = harvest(spark, "coursera", folder, _empty_catalog(spark), AS_OF)
    return merged.select(*CATALOG_COLUMNS)


def ingest_paged(spark, sf_dir):
    folder = V.paged_coursera_feed(spark, sf_dir)
    merged = harvest(spark, "coursera-paged", folder, _empty_catalog(spark), AS_OF)
    return merged.select(*CATALOG_COLUMNS)


def harvest_counts(spark, sf_dir):
    """What each harvest accepted, counted while its batch is written."""
    found = []
    for source, folder, reading in (
        ("edx", V.written_edx_feed(spark, sf_dir), {"pattern": "*.csv"}),
        ("coursera-paged", V.paged_coursera_feed(spark, sf_dir), {}),
    ):
        counts = Observation()
        harvest(spark, source, folder, _empty_catalog(spark), AS_OF, observed=counts, **reading)
        found.append((source, counts.get["accepted"]))
    return spark.createDataFrame(found, "source string, accepted long")


def _unified_feeds(spark, sf_dir):
    edx = V.edx_feed(spark, sf_dir).fillna("").withColumn(merge.SEQUENCE, F.lit(0))
    coursera = V.coursera_feed(spark, sf_dir).select(
        "row.*", F.col("page_id").alias(merge.SEQUENCE)
    )
    return feeds.unified_edx(edx, AS_OF).drop(merge.SEQUENCE), feeds.unified_coursera(
        coursera, AS_OF
    ).drop(merge.SEQUENCE)


def required_fields(spark, sf_dir):
    both = merge.union_sources(*_unified_feeds(spark, sf_dir))
    return (
        merge.accepted(both)
        .groupBy("source_repository")
        .agg(F.count("*").alias("accepted"))
    )


def union_sources(spark, sf_dir):
    both = merge.union_sources(*_unified_feeds(spark, sf_dir))
    return both.select(
        "title", "description", "category", "skills", "level", "original_url",
        "source_repository", "language",
    )


def dedupe_last_wins(spark, sf_dir):
    return merge.last_per_key(V.chats(spark, sf_dir), "original_url", "turn")


def merge_upsert(spark, sf_dir):
    stored = V.courses(spark, sf_dir, skills=True).withColumn("cluster", F.length("title"))
    merged = merge.merge_upsert(
        stored, V.updates(spark, sf_dir).withColumn("cluster", F.lit(None).cast("int"))
    )
    return merged.select(*CATALOG_COLUMNS)


def term_weights(spark, sf_dir):
    weights = item_weights(V.courses(spark, sf_dir), "description")
    return weights.withColumn("weight", F.round("weight", 6))


def similar_pairs_exact(spark, sf_dir):
    pairs = similar_text_pairs(V.courses(spark, sf_dir))
    return pairs.withColumn("score", F.round("score", 6))


def similar_pairs_members(spark, sf_dir):
    """Which courses the texts of the similar pairs stand for."""
    return text_members(V.courses(spark, sf_dir))


def top5_similar(spark, sf_dir):
    near = neighbours(_similarity(spark, sf_dir, rebuild=True))
    return near.withColumn("score", F.round("score", 6))


def top5_after_changes(spark, sf_dir):
    """The neighbour table after some texts have changed, without comparing all others."""
    path, new_path = scratch_path(spark, "neighbours"), scratch_path(spark, "neighbours")
    build_neighbours(V.courses(spark, sf_dir), path)
    update_neighbours(V.reworded(spark, sf_dir), path, new_path)
    near = neighbours(stored_similarity(spark, new_path))
    return near.withColumn("score", F.round("score", 6))


def similar_to_course(spark, sf_dir):
    found = similar_courses(_similarity(spark, sf_dir), V.courses(spark, sf_dir), COURSE_ID)
    return found.withColumn("score", F.round("score", 6))


def _bucketed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the catalog, bucketed by course id."""
    key = (spark.sparkContext.applicationId, f"buckets of {name} in {sf_dir}")
    if key not in _stored:
        table, column = {
            "courses": lambda: (V.courses(spark, sf_dir), "_id"),
            "similarity": lambda: (_similarity(spark, sf_dir), "_id"),
            "likes": lambda: (V.likes(spark, sf_dir), "course_id"),
        }[name]()
        _stored[key] = bucketed(table, name, column)
    return _stored[key]


def similar_bucketed(spark, sf_dir):
    similarity, courses = (_bucketed(spark, sf_dir, n) for n in ("similarity", "courses"))
    found = similar_courses_by_key(similarity, courses, COURSE_ID)
    return found.withColumn("score", F.round("score", 6))


def suggestions_bucketed(spark, sf_dir):
    similarity, likes = (_bucketed(spark, sf_dir, n) for n in ("similarity", "likes"))
    found = suggest_for_all(similarity, likes)
    return found.withColumn("max_score", F.round("max_score", 6))


def suggestions_user(spark, sf_dir):
    mine = V.likes(spark, sf_dir).filter(F.col("user_id") == USER_ID)
    found = suggest_for_all(_similarity(spark, sf_dir), mine)
    return found.select("suggested_course_id", F.round("max_score", 6).alias("max_score"))


def suggestions_all(spark, sf_dir):
    found = suggest_for_all(_similarity(spark, sf_dir), V.likes(spark, sf_dir))
    return found.withColumn("max_score", F.round("max_score", 6))


def similar_pairs_lsh(spark, sf_dir):
    pairs = similar_text_pairs(V.courses(spark, sf_dir), method="lsh")
    return pairs.withColumn("score", F.round("score", 6))


def top5_similar_lsh(spark, sf_dir):
    near = neighbours(find_similar(V.courses(spark, sf_dir), method="lsh"))
    return near.withColumn("score", F.round("score", 6))


def lsh_recall_of_pairs(spark, sf_dir):
    return lsh_recall(V.courses(spark, sf_dir))


def clean_cluster_text(spark, sf_dir):
    return with_cluster_text(V.courses(spark, sf_dir, skills=True)).select("_id", "clustering_text_cleaned")


def clusters(spark, sf_dir):
    return cluster_courses(V.courses(spark, sf_dir, skills=True)).select("_id", "cluster")


def clusters_assigned(spark, sf_dir):
    """All courses by clusters that were fitted on those with skills, and stored."""
    courses, path = V.courses(spark, sf_dir, skills=True), scratch_path(spark, "clusters")
    store_clusters(courses.filter("skills IS NOT NULL"), path)
    return assign_clusters(spark, courses, path).select("_id", "cluster")


def sync_paged(spark, sf_dir):
    """The paged feed as a stream into a stored catalog."""
    store = CatalogStore(spark, scratch_path(spark, "catalog"))
    store.upsert(V.courses(spark, sf_dir, skills=True))
    folder = V.paged_coursera_feed(spark, sf_dir)
    sync_available_now(
        spark, "coursera-paged", folder, store, scratch_path(spark, "sync"), AS_OF
    )
    return store.read().select(*CATALOG_COLUMNS)


def sync_incremental(spark, sf_dir):
    folder = V.written_coursera_feed(spark, sf_dir, files=2)
    store = CatalogStore(spark, scratch_path(spark, "catalog"))
    store.upsert(V.courses(spark, sf_dir, skills=True))
    sync_available_now(
        spark, "coursera", folder, store, scratch_path(spark, "sync"), AS_OF, 1
    )
    return store.read().select(*CATALOG_COLUMNS)


def merge_by_id(spark, sf_dir):
    """A batch by ``_id`` that may set ``cluster``, unlike a harvest."""
    stored = V.courses(spark, sf_dir, skills=True)
    merged = merge.merge_upsert(stored, V.renamed(spark, sf_dir), "_id", preserve=())
    return merged.select(*CATALOG_COLUMNS)


def upsert_partitions(spark, sf_dir):
    store = CatalogStore(spark, scratch_path(spark, "catalog"))
    store.upsert(V.courses(spark, sf_dir, skills=True))
    store.upsert(V.updates(spark, sf_dir))
    return store.read().select(*CATALOG_COLUMNS)


def _regrouped_store(spark, sf_dir):
    store = CatalogStore(spark, scratch_path(spark, "catalog"))
    store.upsert(V.courses(spark, sf_dir))
    store.upsert(V.regrouped(spark, sf_dir))
    return store


def kept_facet_categories(spark, sf_dir):
    return _regrouped_store(spark, sf_dir).category_facet()


def kept_facet_languages(spark, sf_dir):
    return _regrouped_store(spark, sf_dir).language_facet()


def _indexed(word: str) -> Query:
    def run(spark, sf_dir):
        path = scratch_path(spark, "titles")
        build_title_index(_catalog(spark, sf_dir), path)
        return search_titles(_catalog(spark, sf_dir), path, word).select("_id")

    return run


def list_page_deep(spark, sf_dir):
    path, courses = scratch_path(spark, "pages"), V.courses(spark, sf_dir)
    write_sorted(courses, path, file_rows=100)
    found = page_at(spark, path, courses.schema, page=DEEP_PAGE)
    return found.select("_id", "title", "category", "level", "language")


def sync_two_folders(spark, sf_dir):
    """Both feeds, each with its own checkpoint, into one store."""
    store = CatalogStore(spark, scratch_path(spark, "catalog"))
    for source, folder, pattern in (
        ("coursera", V.written_coursera_feed(spark, sf_dir), None),
        ("edx", V.written_edx_feed(spark, sf_dir), "*.csv"),
    ):
        sync_available_now(
            spark, source, folder, store, scratch_path(spark, "sync"), AS_OF, pattern=pattern
        )
    return store.read().select(*CATALOG_COLUMNS)


def queries() -> dict[str, Query]:
    """One entry per operator or composite query, and those of ``llm`` where it is there."""
    found = own_queries() | (llm.queries() if llm else {})
    return found | ({"pipeline": pipeline.run} if pipeline else {})


def own_queries() -> dict[str, Query]:
    return {
        "norm_language": norm_language,
        "norm_language_display": norm_language_display,
        "norm_level": norm_level,
        "course_card": course_card,
        "course_detail": course_detail,
        "list_courses": list_page,
        "list_total": list_total,
        "filter_category": _ids(category="SRC3"),
        "filter_language": _ids(language="French"),
        "filter_language_other": _ids(language="Es"),
        "filter_level": _ids(level="Beginner"),
        "filter_source": _ids(source_repository="COURS"),
        "search_title": _ids(search="The"),
        "highlight_title": highlight_title,
        "course_by_id": lookup_course,
        "page_numbers": page_numbers,
        "category_counts": category_counts,
        "facet_categories": facet_categories,
        "facet_languages": facet_languages,
        "ingest_edx": ingest_edx,
        "ingest_coursera": ingest_coursera,
        "required_fields": required_fields,
        "union_sources": union_sources,
        "dedupe_last_wins": dedupe_last_wins,
        "merge_upsert": merge_upsert,
        "term_weights": term_weights,
        "similar_pairs_exact": similar_pairs_exact,
        "similar_pairs_members": similar_pairs_members,
        "top5_similar": top5_similar,
        "top5_after_changes": top5_after_changes,
        "similar_courses": similar_to_course,
        "suggestions_user": suggestions_user,
        "suggestions_all": suggestions_all,
        "similar_bucketed": similar_bucketed,
        "suggestions_bucketed": suggestions_bucketed,
        "similar_pairs_lsh": similar_pairs_lsh,
        "top5_similar_lsh": top5_similar_lsh,
        "lsh_recall": lsh_recall_of_pairs,
        "clean_cluster_text": clean_cluster_text,
        "cluster_courses": clusters,
        "sync_available_now": sync_incremental,
        "sync_two_folders": sync_two_folders,
        "list_count": list_count,
        "search_title_escaped": _ids(search="n."),
        "search_indexed": _indexed(INDEXED),
        "search_indexed_short": _indexed("n."),
        "list_page_deep": list_page_deep,
        "merge_by_id": merge_by_id,
        "ingest_paged": ingest_paged,
        "sync_paged": sync_paged,
        "harvest_counts": harvest_counts,
        "clusters_assigned": clusters_assigned,
        "upsert_partitions": upsert_partitions,
        "kept_facet_categories": kept_facet_categories,
        "kept_facet_languages": kept_facet_languages,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Top neighbours of every course, exact."""
    return top5_similar(spark, "/root/testdata/sf0.001")


# SQL twins.


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_NAME_SQL = (
    "CASE WHEN language IS NULL OR language = '' THEN 'Other' "
    + " ".join(
        f"WHEN lower(trim(language)) IN ({_quoted(spellings)}) THEN '{group}'"
        for group, spellings in LANGUAGE_GROUPS.items()
    )
    + " ELSE concat(upper(substring(language, 1, 1)), substring(language, 2)) END"
)
_LABEL_SQL = """CASE WHEN language IS NULL OR language = '' THEN 'English'
    WHEN lower(trim(language)) IN ('en', 'en-us', 'english') THEN 'English'
    WHEN length(language) = 2 THEN upper(language) ELSE language END"""
_LEVEL_SQL = """CASE WHEN level IS NULL OR level = '' THEN 'Unspecified'
    WHEN lower(trim(regexp_replace(level, 'level', '', 'gi'))) = 'introductory'
    THEN 'Beginner' ELSE trim(regexp_replace(level, 'level', '', 'gi')) END"""
_MARKED_SQL = f"regexp_replace(title, '({SEARCH})', '<em>\\1</em>', 'gi')"

_ENGLISH = f"lower(trim(language)) IN ({_quoted(LANGUAGE_GROUPS['English'])})"
_BEGINNER = "(lower(level) LIKE '%beginner%' OR lower(level) LIKE '%introductory%')"
_SEARCHED = f"lower(title) LIKE '%{SEARCH}%'"

# TF-IDF over all courses, the pairs of courses and their best five.
_TERMS_SQL = f"""words AS (
    SELECT _id, unnest(string_split_regex(lower(description), '\\s')) AS term FROM courses),
counts AS (
    SELECT _id, term, count(*) AS tf FROM words
    WHERE term NOT IN ({_quoted(STOP_WORDS)}) GROUP BY _id, term),
frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
weighted AS (
    SELECT _id, term, df,
           tf * ln(((SELECT count(*) FROM courses) + 1.0) / (df + 1.0)) AS x
    FROM counts JOIN frequency USING (term)),
norms AS (
    SELECT _id, sqrt(sum(x * x)) AS norm FROM weighted GROUP BY _id HAVING sum(x * x) > 0),
unit AS (
    SELECT _id, term, df, x / norm AS w FROM weighted JOIN norms USING (_id) WHERE x > 0)"""
_SCORES_SQL = """scores AS (
    SELECT a._id AS _id, b._id AS similar_doc_id, sum(a.w * b.w) AS score
    FROM unit a JOIN unit b ON a.term = b.term AND a._id <> b._id
    GROUP BY a._id, b._id HAVING sum(a.w * b.w) > 0.28)"""
_TOP_SQL = """ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY _id ORDER BY round(score, 9) DESC, similar_doc_id) AS rank
    FROM scores),
top5 AS (SELECT _id, rank, similar_doc_id, round(score, 9) AS score FROM ranked
         WHERE rank <= 5)"""
# The same after some texts have changed, with the frequencies from before.
_CHANGED_TERMS_SQL = f"""{V.REWORDED_SQL},
old_words AS (
    SELECT DISTINCT _id, unnest(string_split_regex(lower(description), '\\s')) AS term
    FROM courses),
frequency AS (SELECT term, count(*) AS df FROM old_words GROUP BY term),
words AS (
    SELECT _id, unnest(string_split_regex(lower(description), '\\s')) AS term FROM reworded),
counts AS (
    SELECT _id, term, count(*) AS tf FROM words
    WHERE term NOT IN ({_quoted(STOP_WORDS)}) GROUP BY _id, term),
weighted AS (
    SELECT _id, term,
           tf * ln(((SELECT count(*) FROM courses) + 1.0) / (coalesce(df, 0) + 1.0)) AS x
    FROM counts LEFT JOIN frequency USING (term)),
norms AS (
    SELECT _id, sqrt(sum(x * x)) AS norm FROM weighted GROUP BY _id HAVING sum(x * x) > 0),
unit AS (
    SELECT _id, term, x / norm AS w FROM weighted JOIN norms USING (_id) WHERE x > 0)"""
# One row per distinct text, named by its smallest id.
_TEXTS_SQL = """texts AS (
    SELECT min(_id) AS _id, count(*) AS copies, lower(description) AS text
    FROM courses GROUP BY lower(description))"""

_EDX_SQL = """unified_edx AS (
    SELECT title, CASE WHEN course_description <> '' THEN course_description ELSE summary END
             AS description, subject AS category, level, course_url AS original_url,
           'edX' AS source_repository,
           CASE WHEN language <> '' THEN language ELSE 'en' END AS language
    FROM edx)"""
_COURSERA_SQL = """unified_coursera AS (
    SELECT title, skills, CASE WHEN description <> '' THEN description ELSE course_name END
             AS description, 'General' AS category, level, url AS original_url,
           'Coursera' AS source_repository, 'en' AS language
    FROM coursera)"""
_NEW_ID = "sha256(original_url)"
_MERGED_SQL = f"""WITH {V.COURSES_SQL}, {V.UPDATES_SQL}
            SELECT coalesce(c._id, {_NEW_ID}) AS _id,
                   CASE WHEN u.original_url IS NULL THEN c.title ELSE u.title END AS title,
                   c.description, c.category, c.skills,
                   CASE WHEN u.original_url IS NULL THEN c.level ELSE u.level END AS level,
                   original_url, c.source_repository, c.language,
                   CAST(length(c.title) AS INTEGER) AS cluster
            FROM courses c FULL JOIN updates u USING (original_url)"""
_REGROUPED_SQL = f"""{V.COURSES_SQL}, {V.REGROUPED_SQL}, merged AS (
    SELECT CASE WHEN r.original_url IS NULL THEN c.category ELSE r.category END AS category,
           CASE WHEN r.original_url IS NULL THEN c.language ELSE r.language END AS language
    FROM courses c FULL JOIN regrouped r USING (original_url))"""


def _on_courses(select: str) -> str:
    return f"WITH {V.COURSES_SQL} {select}"


def _on_similarity(select: str, *views: str) -> str:
    parts = [V.COURSES_SQL, _TERMS_SQL, _SCORES_SQL, _TOP_SQL, *views]
    return f"WITH {', '.join(parts)} {select}"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result, column for column."""
    return own_oracle_sql() | (llm.oracle_sql() if llm else {})


def own_oracle_sql() -> dict[str, str]:
    found = _twins()
    found["similar_bucketed"] = found["similar_courses"]
    found["suggestions_bucketed"] = found["suggestions_all"]
    found["ingest_paged"] = found["ingest_coursera"]
    found["sync_paged"] = found["sync_available_now"]
    return found


def _twins() -> dict[str, str]:
    return {
        "norm_language": _on_courses(f"SELECT _id, {_NAME_SQL} AS language_name FROM courses"),
        "norm_language_display": _on_courses(
            f"""SELECT _id, {_LABEL_SQL} AS label,
                coalesce(nullif(language, ''), 'English') AS detail FROM courses"""
        ),
        "norm_level": _on_courses(
            f"""SELECT _id, {_LEVEL_SQL} AS label,
                coalesce(nullif(level, ''), 'Unspecified') AS detail FROM courses"""
        ),
        "course_card": _on_courses(
            f"""SELECT _id, {_MARKED_SQL} AS title,
                coalesce(nullif(category, ''), 'General') AS category,
                {_LABEL_SQL} AS language, {_LEVEL_SQL} AS level,
                coalesce(nullif(source_repository, ''), 'Unknown') AS source
                FROM courses"""
        ),
        "course_detail": _on_courses(
            """SELECT _id, title, coalesce(nullif(category, ''), 'General') AS category,
               coalesce(nullif(language, ''), 'English') AS language,
               coalesce(nullif(level, ''), 'Unspecified') AS level,
               coalesce(nullif(source_repository, ''), 'External') AS source,
               coalesce(nullif(description, ''), 'No description available.')
                 AS description,
               original_url AS url FROM courses"""
        ),
        "list_courses": _on_courses(
            f"""SELECT _id, title, category, level, language FROM courses
                WHERE {_ENGLISH} AND {_SEARCHED} ORDER BY _id LIMIT 18 OFFSET 18"""
        ),
        "list_total": _on_courses(
            f"""SELECT count(*) AS total FROM courses
                WHERE {_ENGLISH} AND {_BEGINNER} AND {_SEARCHED}"""
        ),
        "filter_category": _on_courses(
            "SELECT _id FROM courses WHERE lower(category) = 'src3'"
        ),
        "filter_language": _on_courses(
            f"""SELECT _id FROM courses
                WHERE lower(trim(language)) IN ({_quoted(LANGUAGE_GROUPS['French'])})"""
        ),
        "filter_language_other": _on_courses(
            "SELECT _id FROM courses WHERE lower(trim(language)) = 'es'"
        ),
        "filter_level": _on_courses(f"SELECT _id FROM courses WHERE {_BEGINNER}"),
        "filter_source": _on_courses(
            "SELECT _id FROM courses WHERE lower(source_repository) LIKE '%cours%'"
        ),
        "search_title": _on_courses(f"SELECT _id FROM courses WHERE {_SEARCHED}"),
        "highlight_title": _on_courses(f"SELECT _id, {_MARKED_SQL} AS title FROM courses"),
        "course_by_id": _on_courses(
            f"SELECT _id, title, level FROM courses WHERE _id = '{COURSE_ID}'"
        ),
        "page_numbers": _on_courses(
            """SELECT category, count(*) AS n,
               CAST(ceil(count(*) / 18.0) AS BIGINT) AS pages,
               least(count(*), CAST(ceil(count(*) / 18.0) AS BIGINT)) AS last_page,
               CAST(1 AS BIGINT) AS first_page
               FROM courses GROUP BY category"""
        ),
        "category_counts": _on_courses(
            "SELECT category, count(*) AS n FROM courses GROUP BY category"
        ),
        "facet_categories": f"""WITH {V.PART_CATALOG_SQL}, cut AS (
            SELECT category, count(*) AS n FROM catalog GROUP BY category
            ORDER BY n DESC, category ASC NULLS FIRST LIMIT 30)
            SELECT category, n FROM cut WHERE trim(category) <> ''""",
        "facet_languages": _on_courses(
            f"SELECT DISTINCT {_NAME_SQL} AS language FROM courses WHERE language <> ''"
        ),
        "ingest_edx": f"""WITH {V.EDX_FEED_SQL}, {_EDX_SQL}
            SELECT {_NEW_ID} AS _id, title, description, category,
                   CAST(NULL AS VARCHAR) AS skills, level, original_url,
                   source_repository, language, CAST(NULL AS INTEGER) AS cluster
            FROM unified_edx WHERE title <> '' AND original_url <> ''""",
        "ingest_coursera": f"""WITH {V.COURSERA_FEED_SQL}, {_COURSERA_SQL}
            SELECT {_NEW_ID} AS _id, title, description, category, skills, level,
                   original_url, source_repository, language,
                   CAST(NULL AS INTEGER) AS cluster
            FROM unified_coursera WHERE title <> '' AND original_url <> ''""",
        "required_fields": f"""WITH {V.EDX_FEED_SQL}, {_EDX_SQL},
            {V.COURSERA_FEED_SQL}, {_COURSERA_SQL}
            SELECT source_repository, count(*) AS accepted FROM (
                SELECT source_repository, title, original_url FROM unified_edx UNION ALL
                SELECT source_repository, title, original_url FROM unified_coursera)
            WHERE title <> '' AND original_url <> '' GROUP BY source_repository""",
        "harvest_counts": f"""WITH {V.EDX_FEED_SQL}, {_EDX_SQL},
            {V.COURSERA_FEED_SQL}, {_COURSERA_SQL}
            SELECT 'edx' AS source, count(*) AS accepted
            FROM unified_edx WHERE title <> '' AND original_url <> ''
            UNION ALL SELECT 'coursera-paged', count(*)
            FROM unified_coursera WHERE title <> '' AND original_url <> ''""",
        "union_sources": f"""WITH {V.EDX_FEED_SQL}, {_EDX_SQL},
            {V.COURSERA_FEED_SQL}, {_COURSERA_SQL}
            SELECT title, description, category, CAST(NULL AS VARCHAR) AS skills, level,
                   original_url, source_repository, language FROM unified_edx
            UNION ALL
            SELECT title, description, category, skills, level,
                   original_url, source_repository, language FROM unified_coursera""",
        "dedupe_last_wins": f"""WITH {V.CHATS_SQL}
            SELECT original_url, turn, title, description FROM chats
            QUALIFY row_number() OVER (PARTITION BY original_url ORDER BY turn DESC) = 1""",
        "merge_upsert": _MERGED_SQL,
        "upsert_partitions": _MERGED_SQL.replace(
            "CAST(length(c.title) AS INTEGER)", "CAST(NULL AS INTEGER)"
        ),
        "merge_by_id": f"""WITH {V.COURSES_SQL}, {V.RENAMED_SQL}
            SELECT _id, CASE WHEN r._id IS NULL THEN c.title ELSE r.title END AS title,
                   c.description, c.category, c.skills,
                   CASE WHEN r._id IS NULL THEN c.level ELSE r.level END AS level,
                   c.original_url, c.source_repository, c.language,
                   CAST(CASE WHEN r._id IS NULL THEN c.cluster ELSE r.cluster END AS INTEGER)
                     AS cluster
            FROM courses c FULL JOIN renamed r USING (_id)""",
        "kept_facet_categories": f"""WITH {_REGROUPED_SQL}, cut AS (
            SELECT category, count(*) AS n FROM merged GROUP BY category
            ORDER BY n DESC, category ASC NULLS FIRST LIMIT 30)
            SELECT category, n FROM cut WHERE trim(category) <> ''""",
        "kept_facet_languages": f"""WITH {_REGROUPED_SQL}
            SELECT DISTINCT {_NAME_SQL} AS language FROM merged WHERE language <> ''""",
        "search_indexed": _on_courses(
            f"SELECT _id FROM courses WHERE contains(lower(title), '{INDEXED.lower()}')"
        ),
        "search_indexed_short": _on_courses(
            "SELECT _id FROM courses WHERE contains(lower(title), 'n.')"
        ),
        "list_page_deep": _on_courses(
            f"""SELECT _id, title, category, level, language FROM courses
                ORDER BY _id LIMIT 18 OFFSET {(DEEP_PAGE - 1) * 18}"""
        ),
        "term_weights": f"""WITH {V.COURSES_SQL}, {_TERMS_SQL}
            SELECT _id, term, df, round(w, 6) AS weight FROM unit""",
        "similar_pairs_exact": f"""WITH {V.COURSES_SQL}, {_TERMS_SQL}, {_TEXTS_SQL},
            {_SCORES_SQL}
            SELECT a._id AS id_a, a.copies AS copies_a, b._id AS id_b,
                   b.copies AS copies_b, round(score, 6) AS score
            FROM scores s JOIN texts a ON a._id = s._id
            JOIN texts b ON b._id = s.similar_doc_id""",
        "similar_pairs_members": f"""WITH {V.COURSES_SQL}, {_TERMS_SQL}, {_TEXTS_SQL}
            SELECT c._id, t._id AS id, copies, t._id IN (SELECT _id FROM unit) AS weighted
            FROM courses c JOIN texts t ON t.text IS NOT DISTINCT FROM lower(c.description)""",
        "top5_similar": _on_similarity(
            "SELECT _id, rank, similar_doc_id, round(score, 6) AS score FROM top5"
        ),
        "top5_after_changes": f"""WITH {V.COURSES_SQL}, {_CHANGED_TERMS_SQL},
            {_SCORES_SQL}, {_TOP_SQL}
            SELECT _id, rank, similar_doc_id, round(score, 6) AS score FROM top5""",
        "similar_courses": _on_similarity(
            f"""SELECT c._id AS id, title, level, round(score, 6) AS score
                FROM top5 JOIN courses c ON c._id = similar_doc_id
                WHERE top5._id = '{COURSE_ID}'"""
        ),
        "suggestions_user": _on_similarity(
            f"""SELECT similar_doc_id AS suggested_course_id,
                       round(max(score), 6) AS max_score
                FROM top5 WHERE _id IN (SELECT course_id FROM mine)
                  AND similar_doc_id NOT IN (SELECT course_id FROM mine)
                GROUP BY similar_doc_id
                ORDER BY max(score) DESC, similar_doc_id LIMIT 5""",
            V.LIKES_SQL,
            f"mine AS (SELECT course_id FROM likes WHERE user_id = {USER_ID})",
        ),
        "suggestions_all": _on_similarity(
            """SELECT user_id, rank, suggested_course_id, round(max_score, 6) AS max_score
               FROM best WHERE rank <= 5""",
            V.LIKES_SQL,
            """unseen AS (
                SELECT user_id, similar_doc_id AS suggested_course_id,
                       max(score) AS max_score
                FROM likes l JOIN top5 ON _id = course_id
                WHERE NOT EXISTS (SELECT 1 FROM likes k WHERE k.user_id = l.user_id
                                  AND k.course_id = similar_doc_id)
                GROUP BY user_id, similar_doc_id)""",
            """best AS (
                SELECT *, row_number() OVER (PARTITION BY user_id
                    ORDER BY max_score DESC, suggested_course_id) AS rank FROM unseen)""",
        ),
        "clean_cluster_text": _on_courses(
            """SELECT _id, regexp_replace(coalesce(skills, category, ''),
                   '[^a-zA-Z0-9\\s]', '', 'g') AS clustering_text_cleaned FROM courses"""
        ),
        "list_count": _on_courses(
            """SELECT count(*) AS count FROM (
                SELECT _id FROM courses WHERE lower(category) = 'src3'
                ORDER BY _id LIMIT 18 OFFSET 36)"""
        ),
        "search_title_escaped": _on_courses(
            "SELECT _id FROM courses WHERE contains(lower(title), 'n.')"
        ),
        "sync_two_folders": f"""WITH {V.EDX_FEED_SQL}, {_EDX_SQL},
            {V.COURSERA_FEED_SQL}, {_COURSERA_SQL}
            SELECT {_NEW_ID} AS _id, title, description, category,
                   CAST(NULL AS VARCHAR) AS skills, level, original_url,
                   source_repository, language, CAST(NULL AS INTEGER) AS cluster
            FROM unified_edx WHERE title <> '' AND original_url <> ''
            UNION ALL
            SELECT {_NEW_ID}, title, description, category, skills, level, original_url,
                   source_repository, language, CAST(NULL AS INTEGER)
            FROM unified_coursera WHERE title <> '' AND original_url <> ''""",
        "sync_available_now": f"""WITH {V.COURSES_SQL}, {V.COURSERA_FEED_SQL},
            {_COURSERA_SQL}
            SELECT {', '.join(CATALOG_COLUMNS)} FROM courses
            UNION ALL
            SELECT {_NEW_ID}, title, description, category, skills, level, original_url,
                   source_repository, language, CAST(NULL AS INTEGER)
            FROM unified_coursera WHERE title <> '' AND original_url <> ''""",
    }
