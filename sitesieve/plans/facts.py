"""Facts of a site's pages: the lines that say something, the freshest entries, sources within a budget, and the check of
answers against what the pages say. The reference date is a parameter."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitesieve.functions import dates, fixed, fuzzy, text, urls
from sitesieve.plans import pages

ANSWER = "struct<personalization:string,source_url:string,evidence:string,date:string,reason:string>"


def like(x: Column, pattern: str) -> Column:
    return x.rlike(fixed.java(pattern))


def is_meaningful(line: Column) -> Column:
    """50 to 700 characters, seven words or twenty ideographs, letters 0.6 of all, commas 0.35 of words."""
    words = F.size(F.filter(F.split(line, r"(?U)\s+"), lambda w: w != ""))
    enough = (words >= 7) | (F.regexp_count(line, F.lit("[一-鿿]")) >= 20)
    letters, commas = F.regexp_count(line, F.lit(r"\p{L}")) / F.length(line), F.regexp_count(line, F.lit(",")) / F.greatest(words, F.lit(1))
    return F.length(line).between(50, 700) & enough & (letters >= 0.6) & ~like(line, fixed.BOILERPLATE) & (commas <= 0.35)


def entry_title(line: Column, spans: Column) -> Column:
    """What stands beside a line's date, if it reads like a title; else empty."""
    rest = F.regexp_replace(text.collapsed(dates.without(line, spans)), r"^[ \-—–|:•·]+|[ \-—–|:•·]+$", "")
    return F.when(rest.rlike(r"(?U)[^\W\d_]{2,}") & ~like(rest, fixed.ENTRY_META), rest).otherwise("")


def scored_lines(lines: DataFrame, as_of: datetime.date) -> DataFrame:
    """Lines (site, page_id, kind, place, line, url) with `fact` and `score`: fixed values, as follows. About and News +2;
    a hint of a fact +3; mostly Cyrillic +2, else mostly Latin +1; a date up to a week ahead +4 if fresh, -1 if stale;
    phrases of anybody, greetings and opening hours -3; the first lines of a homepage -2. Meaningless lines go. A dated
    title of under 50 characters takes the next line with it, if that has no date."""
    day = F.lit(as_of)
    x = lines.withColumn("spans", dates.spans(F.col("line"), as_of))
    w = Window.partitionBy("site", "page_id").orderBy("place")
    x = x.withColumns({"day": dates.entry_day(F.col("line"), F.col("spans")), "next": F.lead("line").over(w), "next_dates": F.size(F.lead("spans").over(w)), "n": F.row_number().over(w) - 1})
    joins = F.col("day").isNotNull() & (F.length("line") < 50) & (F.col("next_dates") == 0) & (entry_title(F.col("line"), F.col("spans")) != "")
    x = x.withColumn("fact", F.when(joins, F.concat("line", F.lit(" "), "next")).otherwise(F.col("line"))).filter(is_meaningful(F.col("fact")))
    plus = lambda c, n: F.when(c, n).otherwise(0)
    fact = F.col("fact")
    score = (
        plus(F.col("kind").isin("about", "news"), 2) + plus(like(fact, fixed.FACT_HINT), 3) + F.when(text.cyrillic_share(fact) > 0.5, 2).when(text.latin_share(fact) > 0.5, 1).otherwise(0)
        + F.when(F.col("day") <= F.date_add(day, 7), F.when(dates.is_stale(F.col("day"), day), -1).otherwise(4)).otherwise(0)
        - plus(like(fact, fixed.GENERIC_FACT) | like(fact, fixed.TRIVIAL_NEWS) | like(fact, fixed.OPENING_HOURS), 3) - plus((F.col("kind") == "home") & (F.col("n") < fixed.HERO_LINES), 2)
    )
    return x.withColumn("score", score).drop("spans", "next", "next_dates", "n")


def best_facts(lines: DataFrame, as_of: datetime.date) -> DataFrame:
    """site, page_id, url, score, fact, stale: the line with the greatest score of each site, the first of equals, its
    first two sentences."""
    first = Window.partitionBy("site").orderBy(F.desc("score"), "page_order", "place")
    best = scored_lines(lines, as_of).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return best.select("site", "page_id", "url", F.col("score").cast("bigint").alias("score"), text.first_sentences(F.col("fact")).alias("fact"), F.coalesce(dates.is_stale(F.col("day"), F.lit(as_of)), F.lit(False)).alias("stale"))


def dated_entries(lines: DataFrame, as_of: datetime.date, keys: list[str]) -> DataFrame:
    """keys, place, day, text, rank: entries of each page from the newest: a dated line, with its neighbours if it is
    little more than the date; entries beyond a week ahead, greetings and opening hours go."""
    w = Window.partitionBy(*keys).orderBy("place")
    x = lines.withColumn("spans", dates.spans(F.col("line"), as_of)).withColumns({"day": dates.entry_day(F.col("line"), F.col("spans")), "before": F.lag("line").over(w), "after": F.lead("line").over(w)})
    bare = F.length(text.collapsed(dates.without(F.col("line"), F.col("spans")))) < 40
    near = lambda c: F.when(F.coalesce(F.col(c), F.lit(pages.GAP)) != pages.GAP, F.col(c))
    shown = F.when(bare, F.concat_ws(" ", near("before"), "line", near("after"))).otherwise(F.col("line"))
    x = x.filter("day is not null").withColumn("text", shown).filter((F.col("day") <= F.date_add(F.lit(as_of), 7)) & ~like(F.col("text"), fixed.TRIVIAL_NEWS))
    return x.select(*keys, "place", "day", "text", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("day"), "place")).alias("rank"))


def freshest(entries: DataFrame, as_of: datetime.date, group: str = "site") -> DataFrame:
    """group, day, text: the newest entry of the last twelve months."""
    good = entries.filter(~dates.is_stale(F.col("day"), F.lit(as_of)))
    return good.groupBy(group).agg(F.max_by(F.struct("day", F.left(text.collapsed(F.col("text")), F.lit(200)).alias("text")), F.struct("day", -F.col("place"))).alias("x")).select(group, "x.day", "x.text")


def sources(lines: DataFrame, titles: DataFrame, as_of: datetime.date, per_page: int = 3500, total: int = 10_000) -> DataFrame:
    """site, page_id, rank, content: the text of each site's pages for a prompt: News, About, home; a title, the three
    newest entries where a page has two or more, then lines while they fit per_page and what is left of total. A page of
    under 40 characters is left out, and pages after fewer than 300 are left.

    lines: site, page_id, kind, place, line; titles: page_id, title. What one page leaves is the next one's: a fold over a
    site's few pages."""
    entries = dated_entries(lines, as_of, ["page_id"]).groupBy("page_id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= 3, F.struct("rank", "text")))), lambda e: e["text"]), "\n—\n").alias("newest"))
    order = F.when(F.col("kind") == "news", 0).when(F.col("kind") == "about", 1).when(F.col("kind") == "home", 2).otherwise(3)
    body = lines.groupBy("site", "page_id").agg(F.min(order).alias("o"), F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]).alias("lines"))
    x = body.join(titles, "page_id", "left").join(entries, "page_id", "left")
    head = F.concat_ws("\n", F.when(F.coalesce("title", F.lit("")) != "", F.concat(F.lit("# "), "title")), F.when(F.col("n") >= 2, F.col("newest")))
    x = x.select("site", F.struct("o", "page_id", head.alias("head"), "lines").alias("p"))

    def fit(acc: Column, line: Column) -> Column:
        room = acc["room"]
        whole = F.length(line) + 1 <= room
        cut = F.regexp_replace(F.substring(line, F.lit(1), F.greatest(room, F.lit(0))), r"\s\S*$", "")
        return F.when(room <= 40, acc).otherwise(F.struct(F.when(whole, room - F.length(line) - 1).otherwise(F.lit(0)).alias("room"), F.concat(acc["out"], F.when(acc["out"] == "", "").otherwise("\n"), F.when(whole, line).otherwise(cut)).alias("out")))

    def take(acc: Column, p: Column) -> Column:
        room = F.least(F.lit(per_page), acc["left"]) - F.when(p["head"] == "", 0).otherwise(F.length(p["head"]) + 1)
        text_ = F.aggregate(p["lines"], F.struct(room.alias("room"), F.lit("").alias("out")), fit)["out"]
        content = F.concat_ws("\n", F.nullif(p["head"], F.lit("")), text_)
        skip = (acc["left"] < 300) | (F.length(text_) < 40)
        return F.when(skip, acc).otherwise(F.struct((acc["left"] - F.length(content)).alias("left"), F.array_append(acc["out"], F.struct(p["page_id"].alias("page_id"), content.alias("content"))).alias("out")))

    kind = lines.schema["page_id"].dataType.simpleString()
    start = F.struct(F.lit(total).alias("left"), F.array().cast(f"array<struct<page_id:{kind},content:string>>").alias("out"))
    done = x.groupBy("site").agg(F.array_sort(F.collect_list("p")).alias("ps")).select("site", F.posexplode(F.aggregate("ps", start, take)["out"]).alias("rank", "s"))
    return done.select("site", "s.page_id", "rank", "s.content")


def parsed_answer(raw: Column) -> Column:
    """The object between the outermost braces of a model's answer, fenced or not; null if there is none."""
    body = F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)(\{.*\})", 1)
    return F.from_json(body, ANSWER, {"mode": "PERMISSIVE"})


def is_grounded(quote: Column, content: Column) -> Column:
    """Whether each fragment of a (folded) quote is in the (folded) content: verbatim, or with four words or more of which
    85 % are there."""
    words = lambda x: F.regexp_extract_all(x, F.lit(r"(?U)[^\W_]{3,}"), F.lit(0))
    parts = F.filter(F.split(quote, r"(?U)\s*(?:\.\.\.|…|;)\s*"), lambda p: F.regexp_replace(p, "[ .,]", "") != "")
    share = lambda own, known: F.size(F.filter(own, lambda w: F.array_contains(known, w))) / F.greatest(F.size(own), F.lit(1))
    fits = lambda p, known: content.contains(p) | fixed.let(words(p), lambda own: (F.size(own) >= 4) & (share(own, known) >= 0.85))
    return fixed.let(F.struct(parts.alias("parts"), F.array_distinct(words(content)).alias("known")), lambda v: (F.size(v["parts"]) > 0) & F.forall(v["parts"], lambda p: fits(p, v["known"])))


def located(key: Column, lines: Column) -> Column:
    """Index (from 0) of the first of the (folded) lines that holds the key's first 40 characters, or, across a line
    break, of the first of two that do; -1 if none does or the key is shorter than eight."""
    first = F.substring(F.element_at(F.split(key, r"(?U)\s*(?:\.\.\.|…|;)\s*"), 1), 1, 40)
    two = F.transform(lines, lambda x, i: F.concat(x, F.lit(" "), F.coalesce(F.try_element_at(lines, i + 2), F.lit(""))))
    hit = lambda xs: F.array_position(F.transform(xs, lambda x: x.contains(first)), F.lit(True))
    return F.when(F.length(first) < 8, -1).when(hit(lines) > 0, hit(lines) - 1).otherwise(hit(two) - 1).cast("int")


MARK = " ?\x01 ?"


def folded_lines(content: str) -> Column:
    """A text folded line by line: MARK parts the lines."""
    return fuzzy.folded(F.replace(content, F.lit("\n"), F.lit(" \x01 ")))


def fact_date(answers: DataFrame, as_of: datetime.date) -> DataFrame:
    """answers (evidence, claimed, content and others) with fact_day, fact_year and marked (the folded lines): the latest date in the quote; else the
    date on its line or beside it (one before a year that the quote names is another entry's); else the claimed date, if
    its month is on the page; else the latest year in the quote."""
    x = answers.withColumns({"own": dates.days(dates.spans(F.col("evidence"), as_of)), "lines": F.split("content", "\n"), "key_": fuzzy.folded("evidence"), "marked": folded_lines("content")})
    x = x.withColumn("place", located(F.col("key_"), F.split("marked", MARK)))
    years = F.transform(F.regexp_extract_all("evidence", F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), F.lit(1)), lambda y: y.cast("int"))
    at = lambda d: F.coalesce(F.when(F.col("place") + d >= 0, F.try_element_at("lines", F.col("place") + d + 1)), F.lit(""))
    x = x.withColumns({"years": years, **{f"at{i}": F.when(F.col("place") >= 0, F.try_element_at(dates.days(dates.spans(at(d), as_of)), F.lit(1))) for i, d in enumerate((0, -1, 1))}})
    named = F.coalesce(F.array_max(F.filter("years", lambda y: y <= as_of.year)), F.lit(0))
    beside = [F.when(F.year(f"at{i}") >= named, F.col(f"at{i}")) for i in (1, 2)]
    claimed = F.coalesce(dates.iso(F.col("claimed")), F.try_element_at(dates.days(dates.spans(F.col("claimed"), as_of)), F.lit(1)))
    shown = F.exists(dates.days(dates.spans(F.col("content"), as_of)), lambda d: F.trunc(d, "month") == F.trunc(F.col("said"), "month"))
    x = x.withColumn("said", claimed)
    day = F.coalesce(F.array_max("own"), F.col("at0"), *beside, F.when(shown, F.col("said")))
    return x.withColumns({"fact_day": day, "fact_year": F.when(day.isNull(), F.array_max("years"))}).drop("own", "lines", "place", "key_", "years", "at0", "at1", "at2", "said")


def validated(answers: DataFrame, sources_: DataFrame, as_of: datetime.date, puffery: dict[str, list[str]] | None = None) -> DataFrame:
    """answers (answer_id, site, raw) with verdict and the parts of the answer: the first rule that one breaks, else
    ACCEPTED or NO_DATA. sources_: site, url, kind, content. puffery: stems that count only where the source has one of
    their forms."""
    a = answers.withColumn("a", parsed_answer(F.col("raw"))).withColumns({"text": text.collapsed(F.coalesce("a.personalization", F.lit(""))), "evidence": text.collapsed(F.coalesce("a.evidence", F.lit(""))), "claimed": F.coalesce("a.date", F.lit("")), "key": urls.comparable(F.coalesce("a.source_url", F.lit("")))})
    s = sources_.withColumn("key", urls.comparable(F.col("url"))).select("site", "key", "url", "kind", "content")
    x = fact_date(a.join(s, ["site", "key"], "left").withColumn("content", F.coalesce("content", F.lit(""))), as_of)
    x = x.withColumns({"quote": fuzzy.folded("evidence"), "page": fuzzy.folded("content")})
    t, fresh = F.col("text"), F.coalesce(~dates.is_stale(F.col("fact_day"), F.lit(as_of)), F.col("fact_year") == as_of.year, F.lit(False))
    stems = F.lit(False)
    for stem, forms in (puffery or {}).items():
        known = F.lit(False)
        for form in forms:
            known = known | F.contains(F.lower("content"), F.lit(form))
        stems = stems | (F.contains(F.lower(t), F.lit(stem)) & ~known)
    rules = [
        ("NOT_JSON", F.col("a").isNull() | F.col("a.personalization").isNull() & F.col("a.source_url").isNull() & F.col("a.evidence").isNull() & F.col("a.reason").isNull()), ("EMPTY", t == ""),
        ("NO_DATA", F.regexp_replace(F.lower(t), r'^[ .«»"]+|[ .«»"]+$', "") == fixed.NO_DATA), ("SOURCE", F.col("url").isNull()), ("NO_QUOTE", F.length("evidence") < 12),
        ("NOT_GROUNDED", ~is_grounded(F.col("quote"), F.col("page"))), ("NUMBERS", F.size(text.numbers_missing(t, F.col("content"))) > 0), ("NUMBERS_IN_QUOTE", F.size(text.numbers_missing(t, F.col("evidence"))) > 0),
        ("IDEOGRAPHS", t.rlike(fixed.CJK)), ("TOO_LONG", F.length(t) > fixed.MOST_CHARS), ("TOO_MANY_WORDS", F.size(F.split(t, " ")) > fixed.MOST_WORDS), ("SENTENCES", text.sentences(t) > 2),
        ("LANGUAGE", text.cyrillic_share(t) < 0.5), ("CLICHE", like(t, fixed.PRAISE) | stems), ("NOTICE", like(t, fixed.OPENING_HOURS) | like(t, fixed.TRIVIAL_NEWS)),
        ("RELATIVE_TIME", like(t, fixed.RELATIVE_TIME) & ~fresh), ("OPENING", ~like(t, fixed.OPENING)),
    ]
    verdict = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules], F.lit("ACCEPTED"))
    weak = F.when(like(F.col("evidence"), fixed.GENERIC_FACT) | like(t, fixed.GENERIC_FACT), "phrase of anybody").when((F.col("kind") == "home") & located(F.col("quote"), F.split("marked", MARK)).between(0, fixed.HERO_LINES), "banner")
    return x.select(*answers.columns, verdict.alias("verdict"), "text", "evidence", "url", "fact_day", "fact_year", weak.alias("weak"), fresh.alias("fresh"))


def first_valid(attempts: DataFrame, most: int = 3) -> DataFrame:
    """Of numbered attempts (row, attempt, verdict, text) the first that is accepted or has no data, within `most`."""
    good = attempts.filter((F.col("attempt") <= most) & F.col("verdict").isin("ACCEPTED", "NO_DATA"))
    return good.groupBy("row").agg(F.min_by(F.struct("attempt", "verdict", "text"), "attempt").alias("x")).select("row", "x.*")


def nudge(answers: DataFrame, newest: DataFrame, as_of: datetime.date, days: int = 90) -> DataFrame:
    """Accepted answers with `nudge`: why a better fact may be there: a fresher entry, a weak fact, or a stale one."""
    x = answers.join(newest.select("site", F.col("day").alias("newest"), F.col("text").alias("entry")), "site", "left")
    fresher = F.col("newest").isNotNull() & (F.col("fact_day").isNull() | (F.datediff("newest", "fact_day") > days)) & ~F.contains(F.col("entry"), F.substring("evidence", 1, 40))
    stale = F.coalesce(dates.is_stale(F.col("fact_day"), F.lit(as_of)), dates.year_is_stale(F.col("fact_year"), F.lit(as_of)), F.lit(False))
    return x.withColumn("nudge", F.when(F.col("verdict") == "ACCEPTED", F.when(fresher, "FRESHER").when(F.col("weak").isNotNull(), "WEAK").when(stale, "STALE"))).drop("newest", "entry")


def prompt(company: Column, site: Column, as_of: datetime.date, contents: Column) -> Column:
    """The text a model is given: the company, the day and its pages, numbered."""
    each = F.transform(contents, lambda s, i: F.concat(F.lit("=== ["), (i + 1).cast("string"), F.lit("] URL: "), s["url"], F.lit("\n"), s["content"], F.lit("\n")))
    return F.concat_ws("\n", F.concat(F.lit("Company: "), company), F.concat(F.lit("Site: "), site), F.lit(f"Today: {as_of:%d.%m.%Y}"), F.array_join(each, "\n"))


def quoted(answers: DataFrame, gap: int = 350) -> DataFrame:
    """Model choices of a person for an address (raw, names, email, block, start, stop) with `problem`: what is chosen must
    be among the names extracted, and the quote must be on the page with the name and the address in it."""
    choice = F.from_json(F.regexp_extract("raw", r"(?s)(\{.*\})", 1), "struct<name:int,title:int,fragment:string>")
    x = answers.withColumn("c", choice).withColumns({"who": F.try_element_at("names", F.greatest(F.coalesce("c.name", F.lit(1)), F.lit(1))), "quote": fuzzy.folded(F.coalesce("c.fragment", F.lit(""))), "page": fuzzy.folded("block")})
    far = F.when(F.col("start") >= F.col("who.start"), F.col("start") - F.col("who.stop")).otherwise(F.col("who.start") - F.col("stop"))
    problem = (
        F.when(F.col("c").isNull() | (F.col("raw").rlike(r"^[^{]*$")), "NOT_JSON").when(F.col("c.name").isNull(), "NO_NAME").when((F.col("c.name") < 1) | F.col("who").isNull(), "NAME_NUMBER")
        .when((F.col("quote") == "") | ~F.contains("page", F.col("quote")), "QUOTE").when(~F.contains("quote", fuzzy.folded("who.text")), "QUOTE_WITHOUT_NAME")
        .when(F.contains("c.fragment", F.lit("@")) & ~F.contains("quote", F.lower("email")), "OTHER_ADDRESS").when(far > gap, "GAP")
    )
    return x.withColumn("problem", problem).drop("c", "quote", "page")
