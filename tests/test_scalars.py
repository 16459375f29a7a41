from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from lectern.functions import normalize as N
from lectern.functions import text as X
from lectern.functions.vocabulary import LANGUAGE_GROUPS, STOP_WORDS
from lectern.plans.cards import course_cards, course_details



def test_language_name(column):
    raw = [None, "", " en ", "EN-us", "español", "jap", " fr\t", " x", "pt", "Deutsch", "élan"]
    assert column(raw, N.language_name(F.col("v"))) == [
        "Other", "Other", "English", "English", "Spanish", "Jap", "French", " x",
        "Portuguese", "German", "Élan",
    ]


def test_every_spelling_has_its_group(column):
    spellings = [(s, g) for g, group in LANGUAGE_GROUPS.items() for s in group]
    got = column([s.upper() for s, _ in spellings], N.language_name(F.col("v")))
    assert got == [g for _, g in spellings]


def test_language_label(column):
    raw = [None, "", " EN-us ", "fr", "english", "spanish", "eng"]
    assert column(raw, N.language_label(F.col("v"))) == [
        "English", "English", "English", "FR", "English", "spanish", "eng",
    ]
    assert column([None, "", "fr"], N.language_detail(F.col("v"))) == ["English", "English", "fr"]


def test_level_label(column):
    raw = [None, "", "level", "Beginner Level", "introductory", "Level Introductory LEVEL", " "]
    assert column(raw, N.level_label(F.col("v"))) == [
        "Unspecified", "Unspecified", "", "Beginner", "Beginner", "Beginner", "",
    ]
    assert column([None, "", "x level"], N.level_detail(F.col("v"))) == [
        "Unspecified", "Unspecified", "x level",
    ]


def test_first_filled(column):
    assert column([None, "", " ", "a"], N.first_filled(F.col("v"), F.lit("b"))) == ["b", "b", " ", "a"]
    assert column(["", "a"], N.first_filled(F.col("v"), F.lit(""))) == ["", "a"]
    assert column([None], N.first_filled(F.col("v"), F.lit(None))) == [None]


def test_similarity_from_distance(spark):
    row = spark.range(1).select(N.similarity_from_distance(F.lit(1.2)).alias("s")).first()
    assert abs(row.s - 0.28) < 1e-12


def test_tokens_match_the_ml_tokenizer(spark):
    texts = [
        "", " \t", "a  b", " lead", "trail ", "trail  \n", "nb sp", "Ünïcode ÉTÉ",
        "...", "x\x0by", "one", "  ", "a\r\nb", "\ta", "The  the",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    ml = Tokenizer(inputCol="v", outputCol="ml").transform(df)
    for row in ml.select("v", "ml", X.tokens(F.col("v")).alias("ours")).collect():
        assert row.ours == row.ml, repr(row.v)
    assert spark.createDataFrame([(None,)], "v string").select(X.tokens(F.col("v"))).first()[0] == [""]


def test_stop_words_are_the_spark_defaults(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_scrub(column):
    got = column(["C++ & Go!", "été 1\t2", ""], X.scrub(F.col("v")))
    assert got == ["C  Go", "t 1\t2", ""]


def test_search_is_literal_unless_asked(column):
    titles = ["C++ basics", "c basics", "Data (I)", None, "a.*b"]
    assert column(titles, X.contains_ci(F.col("v"), "c++")) == [True, False, False, None, False]
    assert column(titles, X.contains_ci(F.col("v"), "(")) == [False, False, True, None, False]
    assert column(titles, X.contains_ci(F.col("v"), ".*")) == [False, False, False, None, True]
    assert column(titles, X.contains_ci(F.col("v"), "^c.*s$", regex=True)) == [
        True, True, False, None, False,
    ]


def test_highlight(column):
    titles = ["C++ and c++", "aXbx", None, "\\Ex\\E"]
    assert column(titles, X.highlight(F.col("v"), "c++"))[0] == "<em>C++</em> and <em>c++</em>"
    assert column(titles, X.highlight(F.col("v"), "x"))[1] == "a<em>X</em>b<em>x</em>"
    assert column(titles, X.highlight(F.col("v"), "\\e"))[3] == "<em>\\E</em>x<em>\\E</em>"
    assert column(titles, X.highlight(F.col("v"), "")) == titles


def test_cards_fill_in_defaults(spark):
    schema = (
        "_id string, title string, description string, category string, level string, "
        "language string, source_repository string, original_url string, url string"
    )
    blank = spark.createDataFrame([("1", "t", "", None, None, "", "", "", "u")], schema)
    card = course_cards(blank).first()
    assert card.asDict() == {
        "_id": "1", "title": "t", "category": "General", "language": "English",
        "level": "Unspecified", "source": "Unknown",
    }
    details = course_details(blank).first()
    assert (details.source, details.description, details.url) == (
        "External", "No description available.", "u",
    )
