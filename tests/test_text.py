import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docindex.functions.text import html_to_text, normalize
from docindex.operators.documents import drop_empty, normalize_docs


def expected(text):
    text = unicodedata.normalize("NFC", text)
    text = re.sub("[ \t\x0b\f\r\n]+", " ", text)
    return text.strip("".join(map(chr, range(0x21)))).lower()


def run(spark, texts, engine="jvm"):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    rows = df.select("i", normalize(F.col("t"), engine).alias("n")).collect()
    return [r.n for r in sorted(rows, key=lambda r: r.i)]


CASES = [
    ("Tea\nAND\tSCONES?", "tea and scones?"),
    ("  blanks outside ", "blanks outside"),
    ("Some \t Gaps\n\nIN One", "some gaps in one"),
    ("cafe\u0301", "caf\u00e9"),
    ("caf\u00e9", "caf\u00e9"),
    ("a\u00a0 b", "a\u00a0 b"),
    ("\x00\x1f a\x01b \x02", "a\x01b"),
    ("\u1112\u1161\u11ab", "\ud55c"),
    ("\U0001f600 A\u030a", "\U0001f600 \u00e5"),
    ("a \n", "a"),
    ("", ""),
    (" \t\r\n\x0b\f", ""),
    (None, None),
]


@pytest.mark.parametrize("engine", ["jvm", "arrow"])
def test_known_texts(spark, engine):
    assert run(spark, [t for t, _ in CASES], engine) == [n for _, n in CASES]


def test_unknown_engine(spark):
    with pytest.raises(ValueError):
        normalize(F.col("t"), "perl")


ALPHABET = st.sampled_from(
    list("abzAZ .,#")
    + list("\t\n\x0b\f\r \x00\x1c\x7f\u00a0\u2003")
    + list("\u0228\u0301\u0323\u0304\u1100\u1161\u11a8\u212b\u2126\ufb01\U0001f600")
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=60))
def test_like_the_definition_and_idempotent(spark, texts):
    once = run(spark, texts)
    assert once == [expected(t) for t in texts]
    assert run(spark, texts, "arrow") == once
    assert run(spark, once) == once


def test_evaluated_once_below_the_blank_filter(spark):
    raw = spark.createDataFrame([("u", "A")], "uri string, rawText string")
    plan = drop_empty(normalize_docs(raw, "arrow"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_blank_and_missing_texts_are_dropped(spark):
    raw = spark.createDataFrame(
        [("a", "x"), ("b", " \n"), ("c", None), ("d", "")], "uri string, rawText string"
    )
    assert [r.uri for r in drop_empty(normalize_docs(raw)).collect()] == ["a"]


def test_html(spark):
    page = (
        "<html><STYLE a='b'>p{}</STYLE><!-- <p>no -->\n<p>1 &lt; 2 &amp;&amp; &amp;lt;</p>"
        "<script>\nvar x = '<p>';\n</script>tail"
    )
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(normalize(html_to_text(F.col("h")))).first()[0] == "1 < 2 && &lt; tail"
