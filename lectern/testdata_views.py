"""Catalog-shaped views over the driver's tables, for the registered queries.

Every view has its SQL twin next to it; both map whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.scratch import scratch_path

COURSE_URL = "https://example.org/course/"
CHAT_URL = "https://example.org/chat/"

LEVEL_RULE = """
    CASE WHEN doc_id % 10 = 0 THEN NULL
         WHEN n_chars < 500 THEN 'Introductory'
         WHEN n_chars < 2000 THEN 'Intermediate level'
         ELSE 'Advanced' END"""

COURSES_SQL = f"""courses AS (
    SELECT CAST(doc_id AS VARCHAR) AS _id,
           split_part(text, chr(10), 1) AS title,
           text AS description,
           source AS category,
           CASE WHEN doc_id % 2 = 1 THEN p_name END AS skills,
           {LEVEL_RULE} AS level,
           concat('{COURSE_URL}', doc_id) AS original_url,
           CASE WHEN doc_id % 2 = 0 THEN 'edX' ELSE 'Coursera' END AS source_repository,
           CASE WHEN doc_id % 3 = 0 THEN upper(lang) ELSE lang END AS language,
           CAST(NULL AS INTEGER) AS cluster
    FROM documents LEFT JOIN part ON p_partkey = doc_id)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def courses(spark: SparkSession, sf_dir: str, skills: bool = False) -> DataFrame:
    """One course per document; the join for ``skills`` only where they are used."""
    doc_id = F.col("doc_id")
    documents = table(spark, sf_dir, "documents")
    columns = {
        "_id": doc_id.cast("string"),
        "title": F.split_part("text", F.lit("\n"), F.lit(1)),
        "description": F.col("text"),
        "category": F.col("source"),
        "level": F.expr(LEVEL_RULE),
        "original_url": F.concat(F.lit(COURSE_URL), doc_id.cast("string")),
        "source_repository": F.when(doc_id % 2 == 0, "edX").otherwise("Coursera"),
        "language": F.when(doc_id % 3 == 0, F.upper("lang")).otherwise(F.col("lang")),
        "last_updated": F.to_timestamp(F.lit("2024-01-01 00:00:00")),
        "cluster": F.lit(None).cast("int"),
    }
    if skills:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("doc_id"), "p_name"
        )
        documents = documents.join(parts, "doc_id", "left")
        columns["skills"] = F.when(doc_id % 2 == 1, F.col("p_name"))
    return documents.select(*(c.alias(name) for name, c in columns.items()))


LIKES_SQL = """likes AS (
    SELECT DISTINCT user_id, json_extract_string(props, '$.k') AS course_id
    FROM events WHERE event_type = 'purchase')"""


def likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purchase is a like of the course that the event names."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select("user_id", F.get_json_object("props", "$.k").alias("course_id"))
        .distinct()
    )


PART_CATALOG_SQL = "catalog AS (SELECT p_name AS category FROM part)"


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by name: more category values than a facet shows."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("category"))


# The first feed: some cells are empty so that the fallbacks and the required-field
# rule have work to do.
EDX_FEED_SQL = f"""edx AS (
    SELECT CASE WHEN n_chars < 100 THEN '' ELSE source END AS title,
           CASE WHEN lang = 'fr' THEN '' ELSE text END AS course_description,
           concat('Summary of ', doc_id) AS summary,
           source AS subject,
           coalesce({LEVEL_RULE}, '') AS level,
           concat('{COURSE_URL}', doc_id) AS course_url,
           CASE WHEN lang = 'de' THEN '' ELSE lang END AS language
    FROM documents)"""


def edx_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("n_chars") < 100, "").otherwise(F.col("source")).alias("title"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("text")).alias("course_description"),
        F.concat(F.lit("Summary of "), F.col("doc_id").cast("string")).alias("summary"),
        F.col("source").alias("subject"),
        F.expr(LEVEL_RULE).alias("Level"),
        F.concat(F.lit(COURSE_URL), F.col("doc_id").cast("string")).alias("course_url"),
        F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("language"),
    )


COURSERA_FEED_SQL = """coursera AS (
    SELECT regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
           regexp_extract(html, '<html lang="(..)"', 1) AS skills,
           CASE WHEN page_id % 5 = 0 THEN NULL ELSE html END AS description,
           concat('Course ', page_id) AS course_name,
           CASE WHEN page_id % 2 = 0 THEN 'Beginner level' END AS level,
           url
    FROM pages)"""


def coursera_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_id = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        page_id,
        F.struct(
            F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
            F.regexp_extract("html", '<html lang="(..)"', 1).alias("Skills"),
            F.when(page_id % 5 != 0, F.col("html")).alias("Description"),
            F.concat(F.lit("Course "), page_id.cast("string")).alias("Course Name"),
            F.when(page_id % 2 == 0, "Beginner level").alias("Level"),
            F.col("url").alias("URL"),
        ).alias("row"),
    )


def written_edx_feed(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """The first feed as CSV files named for the reader; returns their folder."""
    feed = edx_feed(spark, sf_dir)
    path = scratch_path(spark, "edx-feed")
    (feed.repartition(files) if files else feed).write.options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def _coursera_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the 100 rows at most whose ids are from ``offset`` on."""
    return (
        coursera_feed(spark, sf_dir)
        .groupBy((F.floor(F.col("page_id") / 100) * 100).alias("offset"))
        .agg(F.sort_array(F.collect_list(F.struct("page_id", "row"))).alias("rows"))
        .withColumn("rows", F.transform("rows", lambda r: F.struct(r["row"].alias("row"))))
    )


def paged_coursera_feed(spark: SparkSession, sf_dir: str) -> str:
    """The second feed with a folder per page; returns the folder of these."""
    path = scratch_path(spark, "coursera-paged")
    _coursera_pages(spark, sf_dir).write.partitionBy("offset").json(path)
    return path


def written_coursera_feed(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """The second feed as saved pages of 100 rows; returns their folder."""
    pages = _coursera_pages(spark, sf_dir).select("rows")
    path = scratch_path(spark, "coursera-feed")
    (pages.repartition(files) if files else pages).write.json(path)
    return path


UPDATES_SQL = f"""updates AS (
    SELECT concat('{COURSE_URL}', doc_id) AS original_url,
           concat('Rated course ', doc_id) AS title,
           CASE WHEN quality = 1 THEN 'Advanced' END AS level
    FROM labels
    UNION ALL
    SELECT url, regexp_extract(html, '<title>(.*?)</title>', 1), NULL FROM pages)"""


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with few fields: rated courses are stored ones, pages are new."""
    doc_id = F.col("doc_id").cast("string")
    rated = table(spark, sf_dir, "labels").select(
        F.concat(F.lit(COURSE_URL), doc_id).alias("original_url"),
        F.concat(F.lit("Rated course "), doc_id).alias("title"),
        F.when(F.col("quality") == 1, "Advanced").alias("level"),
    )
    new = table(spark, sf_dir, "pages").select(
        F.col("url").alias("original_url"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.lit(None).cast("string").alias("level"),
    )
    return rated.unionByName(new)


REGROUPED_SQL = f"""regrouped AS (
    SELECT concat('{COURSE_URL}', doc_id) AS original_url,
           CASE WHEN quality = 1 THEN 'Graded' ELSE ' ' END AS category,
           'Français' AS language
    FROM labels)"""


def regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that moves rated courses to other categories and to another language."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit(COURSE_URL), F.col("doc_id").cast("string")).alias("original_url"),
        F.when(F.col("quality") == 1, "Graded").otherwise(" ").alias("category"),
        F.lit("Français").alias("language"),
    )


RENAMED_SQL = """renamed AS (
    SELECT CAST(doc_id AS VARCHAR) AS _id, concat('Rated course ', doc_id) AS title,
           CASE WHEN quality = 1 THEN 'Advanced' END AS level, quality AS cluster
    FROM labels)"""


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that names stored courses by id."""
    doc_id = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "labels").select(
        doc_id.alias("_id"),
        F.concat(F.lit("Rated course "), doc_id).alias("title"),
        F.when(F.col("quality") == 1, "Advanced").alias("level"),
        F.col("quality").cast("int").alias("cluster"),
    )


REWORDED_SQL = """reworded AS (
    SELECT c._id, CASE WHEN quality = 0 THEN concat('Withdrawn ', description)
                       ELSE description END AS description
    FROM courses c LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = c._id)"""


def reworded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The courses of poor quality, each with one more word."""
    poor = table(spark, sf_dir, "labels").filter("quality = 0")
    poor = poor.select(F.col("doc_id").cast("string").alias("_id")).distinct()
    return courses(spark, sf_dir).join(poor, "_id", "left_semi").select(
        "_id", F.concat(F.lit("Withdrawn "), "description").alias("description")
    )


CHATS_SQL = f"""chats AS (
    SELECT concat('{CHAT_URL}', conv_id) AS original_url, turn, role AS title,
           text AS description
    FROM conversations)"""


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation are versions of one record."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit(CHAT_URL), F.col("conv_id").cast("string")).alias("original_url"),
        "turn",
        F.col("role").alias("title"),
        F.col("text").alias("description"),
    )
