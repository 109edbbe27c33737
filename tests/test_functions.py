"""Vectors of the scalar functions, in several scripts."""

import pytest
from pyspark.sql import functions as F

from sitesieve.functions import dates, html, text, urls
from sitesieve.operators import relational as R


def value(spark, f, *given):
    df = spark.createDataFrame([given], ", ".join(f"c{i} string" for i in range(len(given))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(given))])).first()[0]


@pytest.mark.parametrize(
    "f, given, wanted",
    [
        (text.collapsed, " a  b\n", "a b"), (text.normal, "  Ёлка  И Ёж ", "елка и еж"), (text.latin, "Щука-Яна", "schuka-yana"),
        (text.squashed, "Philipp", "filip"), (text.squashed, "Ункомтех", "unkomteh"), (text.squashed, "uncomtech", "unkomteh"), (text.squashed, "Техносфера", "tehnosfera"), (text.digit_runs, "a1 b22 1", ["1", "22"]), (text.digit_runs, "1 500 и 1,500,000", ["1500", "1500000"]), (text.sentences, "One. Two! Three", 2), (text.sentences, "Он жил в г. Москва. Да! Нет", 2),
        (text.masked_mobiles, "call +7 (916) 123-45-67, 8 495 1234567", "call +7 (***) ***-**-67, 8 495 1234567"), (text.words_at_bytes, "a b c", 3),
        (text.emails, "x a@b.example, a@b.example y", ["a@b.example"]), (urls.host, "HTTPS://www.A.Example:80/x", "a.example"),
        (urls.site, "m.shop.co.uk", "shop.co.uk"), (urls.site, "a.shop.msk.ru", "shop.msk.ru"), (urls.site, "x.net.de", "net.de"), (urls.site, "a.b.example.com", "example.com"), (urls.core, "m.acme.example", "acme"),
        (urls.clean_path, "/a/./b/../c", "/a/c"), (urls.requested, "http://a.ru/a/../private/x#f", "http://a.ru/private/x"), (urls.requested, "http://a.ru/a/%2e%2E/", "http://a.ru/"), (urls.requested, "ftp://a.ru/../x", "ftp://a.ru/../x"), (urls.without_tracking, "http://a.example/?page=2&ref=x#t", "http://a.example/?page=2"),
        (html.title, "<title> A &amp; B </title>", "A & B"), (html.visible, "<p>a<script>x</script> <b>b</b>", "a b"), (html.lines, "<p>aa</p><p>aa</p><div>bb", ["aa", "bb"]),
    ],
)
def test_vectors(spark, f, given, wanted):
    assert value(spark, f, given) == wanted


def test_dates(spark):
    assert str(value(spark, dates.iso, "on 2024-02-31")) == "None"
    assert str(value(spark, dates.iso, "since 2024-02")) == "2024-02-29"
    assert value(spark, lambda a, b: dates.whole_months(a.cast("date"), b.cast("date")), "2024-01-31", "2024-03-30") == 1


def test_typo(spark):
    assert value(spark, text.is_typo, "ivanov", "ivanof") and not value(spark, text.is_typo, "box1", "box2")


def test_opt_out_is_idempotent(spark):
    df = spark.createDataFrame([("a@x.example", "write a@x.example"), ("b@x.example", "see a@x.example")], "email string, note string")
    listed = df.filter("email like 'a%'").select(F.sha2("email", 256).alias("sha256"))
    once = R.forgotten(df, F.col("email"), listed, ["note"], r"a@x\.example")
    assert [tuple(r) for r in once.collect()] == [("b@x.example", "see [removed]")]
    assert R.forgotten(once, F.col("email"), listed, ["note"], r"a@x\.example").collect() == once.collect()


def test_split_is_balanced(spark):
    df = spark.createDataFrame([(i, f"s{i % 7}") for i in range(61)], "id int, s string")
    arms = R.split_ab(df, "s", F.col("id").cast("string"), "seed").groupBy("s").pivot("arm", ["A", "B"]).count().na.fill(0).collect()
    assert all(abs(r.A - r.B) <= 1 for r in arms) and abs(sum(r.A - r.B for r in arms)) <= 1
