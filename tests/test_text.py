import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nassaj.functions import clean as cl
from nassaj.functions import fixed, stats, tokens
from nassaj.functions.arrays import ngrams, value_counts
from nassaj.operators.stoplists import remove_listed_tokens
from nassaj.workload.views import respell
from tests.conftest import plan_of

MIXED = "هَذَا نَصٌّ تَجْرِيبِيٌّ! رقم 123 و English."


@pytest.mark.parametrize("op, text, expected", [
    (cl.remove_diacritics, "هَذَا", "هذا"),
    (cl.remove_tatweel, "نصـــ طويل", "نص طويل"),
    (cl.normalize_alef, "آية إيمان أحمد", "اية ايمان احمد"),
    (cl.normalize_teh_marbuta, "مدرسة جامعة", "مدرسه جامعه"),
    (cl.remove_english, "نص مع English حروف", "نص مع  حروف"),
    (cl.remove_english, "café ÜBER", "é Ü"),
    (cl.remove_numbers, "123 و ٤٥٦", " و "),
    (cl.remove_numbers, "۰۹x", "x"),
    (cl.remove_extra_whitespace, "  كثير    مسافات   ", "كثير مسافات"),
    (cl.remove_extra_whitespace, " a 　b\x1f\x85c\n", "a b c"),
    (cl.remove_punctuation, "مرحباً، كيف حالك؟!", "مرحباً كيف حالك"),
    (cl.remove_punctuation, "a“b”–c٪", "a“b”–c٪"),
])
def test_single_steps(one, op, text, expected):
    assert one(op, text) == expected


def test_clean_default(one):
    cleaned = one(cl.clean, MIXED)
    assert cleaned == "هذا نص تجريبي رقم 123 و English"


@pytest.mark.parametrize("text", ["", None, "  \n\t "])
@pytest.mark.parametrize("config", [None, {"remove_extra_whitespace": False}])
def test_clean_blank(one, text, config):
    assert one(lambda c: cl.clean(c, config), text) == ""


def test_clean_flags(one):
    text = "هَذَا، نَصّ!"
    assert "َ" in one(lambda c: cl.clean(c, {"remove_diacritics": False}), text)
    assert "،" in one(lambda c: cl.clean(c, {"remove_punctuation": False}), text)
    assert one(lambda c: cl.clean(c, {"remove_english": True, "remove_numbers": True}), MIXED) == "هذا نص تجريبي رقم و"


def test_punctuation_set_holds_tatweel(one):
    assert one(lambda c: cl.clean(c, {"remove_tatweel": False}), "نصـــ") == "نص"
    off = {"remove_tatweel": False, "remove_punctuation": False}
    assert one(lambda c: cl.clean(c, off), "نصـــ") == "نصـــ"


def test_unknown_flag_is_rejected():
    with pytest.raises(ValueError, match="remove_emoji"):
        cl.CleanConfig.of({"remove_emoji": True})


def test_clean_dataframe(spark):
    df = spark.createDataFrame([("هَذَا نَص",), ("نَصّ آخر",)], "text string")
    added = cl.clean_dataframe(df, "text", "cleaned")
    assert added.columns == ["text", "cleaned"]
    assert added.first()["cleaned"] == "هذا نص"
    assert cl.clean_dataframe(df, "text").columns == ["text"]


def test_tokenize(one):
    assert one(tokens.tokenize, "هذا نص عربي") == ["هذا", "نص", "عربي"]
    assert one(tokens.tokenize, "") == [] == one(tokens.tokenize, "   ") == one(tokens.tokenize, None)
    assert one(lambda c: tokens.tokenize(c, split_punct=True), "a,b (c)") == ["a", ",", "b", "(", "c", ")"]


def test_stopwords(one, spark):
    assert len(set(fixed.STOPWORDS)) == len(fixed.STOPWORDS) == 59
    words = ["في", "المنزل", "هذا", "كتاب", "x"]
    assert one(tokens.remove_stopwords, words, "array<string>") == ["المنزل", "كتاب"]
    assert one(lambda c: tokens.process_tokens(c, remove_stops=False), "في بيت") == ["في", "بيت"]
    # Letters rewritten by cleaning no longer match the list, unless it is rewritten too.
    assert one(lambda c: tokens.process_tokens(cl.clean(c)), "إلى بيت") == ["الى", "بيت"]
    rewritten = tokens.stopword_list(normalize=True)
    assert one(lambda c: tokens.process_tokens(cl.clean(c), True, rewritten), "إلى بيت") == ["بيت"]


def test_listed_tokens_keep_order_and_emptied_texts(spark):
    df = spark.createDataFrame([(1, ["b", "bb", "aa", "cc", "aa"]), (2, ["aa"]), (3, [])], "id long, tokens array<string>")
    stop = spark.createDataFrame([("aa",), ("aa",)], "word string")
    rows = {r["id"]: r["tokens"] for r in remove_listed_tokens(df, stop).collect()}
    assert rows == {1: ["bb", "cc"], 2: [], 3: []}


@pytest.mark.parametrize("word, expected", [
    ("المدرسة", "مدرسة"), ("بالكتاب", "كتاب"), ("كتابهم", "كتاب"), ("من", "من"), ("بيت", "يت"),
    ("والب", "الب"), ("كتابكما", "كتاب"), ("سوفبتين", "بت"),
])
def test_stem(one, word, expected):
    assert one(tokens.stem, word) == expected == step_by_step(word)
    assert one(tokens.stem_words, [word], "array<string>") == [expected]


def step_by_step(word: str) -> str:
    """One affix per pass, longest first."""
    for affixes, cut in ((fixed.PREFIXES, lambda w, a: w[len(a):] if w.startswith(a) else None),
                         (fixed.SUFFIXES, lambda w, a: w[:-len(a)] if w.endswith(a) else None)):
        for _ in range(3):
            rest = [r for a in sorted(affixes, key=len, reverse=True) if (r := cut(word, a)) and len(r) >= 2]
            if not rest:
                break
            word = rest[0]
    return word


arabic = st.text(alphabet="السفولبتينأإهمكماةx", min_size=1, max_size=9)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(arabic, min_size=1, max_size=60))
def test_stem_property(spark, words):
    df = spark.createDataFrame([(words,)], "t array<string>")
    both = df.select(tokens.stem_tokens(F.col("t")).alias("a"), tokens.stem_words(F.col("t")).alias("b")).first()
    expected = [step_by_step(w) for w in words]
    assert both["a"] == expected == both["b"]
    assert all(len(s) >= min(2, len(w)) for s, w in zip(expected, words))


def test_stem_tokens_with_spaces_and_empty_list(one):
    assert one(tokens.stem_tokens, ["ال بيت"], "array<string>") == [" بيت"]
    assert one(tokens.stem_words, [], "array<string>") == []


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="اأإآةهَُـ ،؟!.ab12\n ", max_size=20), min_size=1, max_size=30))
def test_clean_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = df.select("id", cl.clean(F.col("t")).alias("c"), cl.clean(cl.clean(F.col("t"))).alias("cc")).collect()
    table = str.maketrans(
        fixed.ALEF_FORMS + fixed.TEH_MARBUTA, "اااه",
        fixed.DIACRITICS + "،؛؟«»…ـ" + string.punctuation,
    )
    for r in rows:
        assert r["c"] == r["cc"] == re.sub(r"\s+", " ", texts[r["id"]].translate(table)).strip()


def test_processor_struct_and_frame(spark, one):
    p = tokens.TextProcessor()
    plain = one(lambda c: p.run(c), "هَذَا الكتاب")
    assert plain.asDict() == {
        "original": "هَذَا الكتاب", "cleaned": "هذا الكتاب", "tokens": ["الكتاب"], "stemmed_tokens": ["الكتاب"],
    }
    assert one(lambda c: p.run(c, apply_stemming=True), "هَذَا الكتاب")["stemmed_tokens"] == ["كتاب"]
    df = spark.createDataFrame([("هَذَا نَص",), ("نص آخر",)], "text string")
    assert p.run_on_dataframe(df, "text").columns == ["text", "cleaned_text", "tokens"]
    assert p.run_on_dataframe(df, "text", True, True).columns[-1] == "stemmed_tokens"
    assert p.run_on_dataframe(df, "text").count() == 2


def test_replaced_stages(one):
    p = tokens.TextProcessor(cleaner=F.lower, tokenizer=lambda c: F.split(c, "-"), stemmer=lambda t: F.transform(t, F.reverse))
    out = one(lambda c: p.run(c, remove_stops=False, apply_stemming=True), "AB-CD")
    assert (out["cleaned"], out["tokens"], out["stemmed_tokens"]) == ("ab-cd", ["ab", "cd"], ["ba", "dc"])


def test_text_plan_is_one_native_stage(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = tokens.TextProcessor().run_on_dataframe(df, "text", True, True)
    plan = plan_of(out.withColumn("s", stats.summary(F.col("text"))))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan_of(out.select("cleaned_text")).count("translate(") == 1


def test_statistics(one):
    text = "كتاب كتاب ab c"
    assert one(stats.summary, text).asDict() == {
        "word_count": 4, "char_count": 14, "avg_word_length": 2.75, "arabic_char_ratio": 0.5714,
        "unique_words": 3, "lexical_diversity": 0.75,
    }
    assert one(stats.char_count, "𝒳é") == 2
    for op in (stats.avg_word_length, stats.arabic_char_ratio, stats.lexical_diversity):
        assert one(op, "") == 0.0 == one(op, None)


def test_corpus_summary(spark):
    rows = [("x", "aa b"), ("x", "b cc"), ("y", ""), (None, "q")]
    out = {r["g"]: r for r in stats.corpus_summary(spark.createDataFrame(rows, "g string, t string"), "t", "g").collect()}
    assert (out["x"]["documents"], out["x"]["words"], out["x"]["unique_words"], out["x"]["lexical_diversity"]) == (2, 4, 3, 0.75)
    assert (out["y"]["unique_words"], out["y"]["lexical_diversity"]) == (0, 0.0)
    assert out[None]["words"] == 1


def test_array_helpers(one):
    counts = one(value_counts, ["b", "a", "b"], "array<string>")
    assert [(r["value"], r["n"]) for r in counts] == [("a", 1), ("b", 2)]
    assert one(value_counts, [], "array<string>") == []
    assert one(lambda c: ngrams(c, 2), ["a", "b", "c"], "array<string>") == ["a b", "b c"]
    assert one(lambda c: ngrams(c, 3), ["a", "b"], "array<string>") == []


def test_respell(one):
    assert one(respell, "Book 7?") == "بــك ٧؟"
