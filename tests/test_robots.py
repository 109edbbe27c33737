"""Robots rules: groups, globs, spellings, verdicts, states and odd files."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from sitesieve.functions import robots


def test_globs_like_a_plain_matcher(spark):
    rng = random.Random(3)
    cases = [("/" + "".join(rng.choices("ab*", k=rng.randint(0, 5))) + rng.choice(["", "$"]), "/" + "".join(rng.choices("ab", k=rng.randint(0, 6)))) for _ in range(400)]
    df = spark.createDataFrame(cases, "key string, p string")
    for key, p, got in df.select("key", "p", robots.matches(F.col("key"), F.col("p"))).collect():
        assert got == fnmatch.fnmatchcase(p, key[:-1] if key.endswith("$") else key + "*"), (key, p)


@pytest.mark.parametrize("given, wanted", [("/a%2fb", "/a%2Fb"), ("/%41%7e", "/A~"), ("/é", "/%C3%A9"), ("/100%", "/100%25"), ("/%zz", "/%25zz"), ("/a b|<\"", "/a%20b%7C%3C%22"), ("/%2F%2a", "/%2F%2A"), ("", ""), ("/%c3%a9", "/%C3%A9")])
def test_spelling(spark, given, wanted):
    assert spark.createDataFrame([(given,)], "x string").select(robots.spelled(F.col("x"))).first()[0] == wanted


FILES = [
    ("own", "\ufeffUser-agent: *\r\nDisallow: /\r\nUser-agent: My-Bot\r\nAllow: /a\r\nDisallow: /a # tie\r\nUser-Agent: my-bot\nDisallow: /b/*.x$"),
    ("star", "user-agent: other\nDisallow: /\nUSER-AGENT: *\nSitemap: http://a.example/\nDisallow: /c"),
    ("open", "User-agent: my-bot\nDisallow:\nUser-agent: *\nDisallow: /"),
    ("early", "Disallow: /\nno colon here"), ("none", None), ("empty", ""),
]


@pytest.mark.parametrize("base, p, wanted", [("own", "/z", True), ("own", "/a1", True), ("own", "/b/1.x", False), ("own", "/b/1.xy", True), ("star", "/c", False), ("star", "/d", True), ("open", "/q", True), ("early", "/q", True), ("none", "/", True), ("empty", "/", True)])
def test_verdicts(spark, base, p, wanted):
    files = spark.createDataFrame(FILES, "base string, text string")
    pages = spark.createDataFrame([(base, p)], "base string, p string")
    assert pages.join(robots.rules(files, "my-bot"), "base", "left").select(robots.verdict(F.col("rules"), F.col("p"))["allowed"]).first()[0] is wanted


def test_states(spark):
    rows = [(200, "User-agent: *"), (204, ""), (200, None), (404, None), (429, None), (301, None), (503, None), (None, None)]
    df = spark.createDataFrame(rows, "status int, body string")
    assert [r[0] for r in df.select(robots.state(F.col("status"), F.col("body"))).collect()] == ["rules", "open", "open", "open", "closed", "closed", "closed", "closed"]


@pytest.mark.parametrize("agent, wanted", [("Mozilla/5.0 (compatible; OutreachResearchBot/1.0; +x)", "outreachresearchbot"), ("Mozilla/5.0 Chrome/1", ""), ("my-bot/2", "my-bot")])
def test_tokens(spark, agent, wanted):
    assert spark.createDataFrame([(agent,)], "x string").select(robots.token(F.col("x"))).first()[0] == wanted


def test_paths_lose_their_dot_segments(spark):
    df = spark.createDataFrame([("http://a.ru/a/../private/x",), ("http://a.ru/a/%2e%2e/private/x",), ("http://a.ru",)], "x string")
    assert [r[0] for r in df.select(robots.path(F.col("x"))).collect()] == ["/private/x", "/private/x", "/"]


def test_answers_and_bytes(spark):
    import gzip

    rows = [(200, gzip.compress(b"Disallow: /")), (200, b"\x1f\x8bbroken"), (200, "Disallow: /\n# \u0440".encode("cp1251")), (200, b"<html>"), (302, None), (0, None)]
    df = spark.createDataFrame(rows, "status int, raw binary").select(robots.answer(F.col("status"), robots.decoded("raw")).alias("a"))
    assert [(r.a.state, r.a.why) for r in df.collect()] == [("rules", "file"), ("closed", "not unpacked"), ("rules", "file"), ("open", "a page"), ("closed", "redirect without a file"), ("closed", "no answer")]
