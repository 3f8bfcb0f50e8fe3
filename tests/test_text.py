import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X


def each(spark, values, rule):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string").withColumn("out", rule(F.col("s")))
    return [r["out"] for r in rows.orderBy("i").collect()]


@pytest.mark.parametrize(
    "rule, given, wanted",
    [
        (X.flatten_latex, [r"r_f", r"\frac{C}{1+r}", r"\$ 5 0 0", "x^{2}", "a b"], ["rf", "C1+r", "$500", "x2", "ab"]),
        (X.strip_markup, ["a<sup>2</sup> <sub>i</sub> <super>"], ["a2 i <super>"]),
        (X.nfkc, ["ﬁne ½ Å", "plain", "", None], ["fine 1⁄2 Å", "plain", "", None]),
        (X.plain_punctuation, ["“a” ‘b’ c–d—e−f"], ["\"a\" 'b' c-d-e-f"]),
        (X.drop_soft_hyphens, ["invest­\n  ing and­ so"], ["investing and so"]),
        (X.dehyphenate, ["exam-\nple of supply-and-demand", "- 1,000 and -5", "a-b-c-d", "é-é²-Ⅷ"], ["example of supplyanddemand", "- 1,000 and -5", "abcd", "éé²Ⅷ"]),
        (X.drop_list_markers, ["• one\n- two\n * three\n1. four\nfive - six\r- seven"], ["  one\ntwo\nthree\n1. four\nfive - six\r- seven"]),
        (X.join_spaced_caps, ["PA R T I I I of it", "the US GDP rose", "A B", "X A B C d", "A B C"], ["PARTIII of it", "the US GDP rose", "A B", "XABC d", "ABC"]),
        (X.drop_zero_width, ["a​b ​"], ["ab "]),
        (X.strip, ["  a b\x1c\n", ""], ["a b", ""]),
        (X.collapse, [" a   b\x1fc\n", ""], ["a b c", ""]),
        (X.fold, ["C H A P T E R  Straße", "É"], ["chapter strasse", "é"]),
    ],
)
def test_rules(spark, rule, given, wanted):
    assert each(spark, given, rule) == wanted


def test_tokens_are_those_of_split(spark):
    random.seed(1)
    given = ["".join(random.choice("ab é\t\n\x0b\x1c\x1f\x85  　") for _ in range(30)) for _ in range(200)]
    assert each(spark, given, X.tokenize) == [s.split() for s in given]


def test_spaced_caps_equal_a_scan_over_tokens(spark):
    def scan(s):
        return re.sub(r"(?<!\S)[A-Z]{1,2}(?:[ \t]+[A-Z]{1,2}){2,}(?!\S)", lambda m: "".join(m[0].split()), s)

    random.seed(2)
    given = [" ".join(random.choice(["A", "BC", "DEF", "g", "H\n", "I."]) for _ in range(12)) for _ in range(500)]
    assert each(spark, given, X.join_spaced_caps) == [scan(s) for s in given]


def test_chain(spark):
    given = ["• “Supply-and-\ndemand”  of ﬁrms​<sup>2</sup>"]
    assert each(spark, given, lambda c: X.tokenize(X.normalize(c, X.MD_RULES))) == [['"Supplyanddemand"', "of", "firms2"]]
    assert X.MD_RULES[1:] == X.PDF_RULES and X.nfkc not in X.without_python(X.MD_RULES)


def test_nfkc_is_unicodedata(spark):
    given = [chr(c) for c in range(0xA0, 0x2200)]
    assert each(spark, given, X.nfkc) == [unicodedata.normalize("NFKC", s) for s in given]
