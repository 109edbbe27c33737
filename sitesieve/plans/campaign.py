"""Bases, letters and the checks between them: page evidence for a row, enrichment decisions, templates rendered over
contacts, constraints of an export, and agreement of documents with tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitesieve.functions import fixed, html, text, urls
from sitesieve.operators import relational as R

WINDOW = 350
RANDOM = r"\{\{RANDOM\s+([^{}]*)\}\}"
VARIABLE = r"\{\{([^{}|]+)\}\}"


# --- evidence on a page


def folded(x: Column) -> Column:
    return text.normal(F.translate(x, " ", " "))


def contact_text(page: Column) -> Column:
    """Visible text with the addresses of mail links where they stand."""
    return html.visible(F.regexp_replace(page, r"""(?i)(<a\s[^>]*href\s*=\s*["']mailto:([^"'?]+)[^>]*>)""", "$1 $2 "))


def signal_text(page: Column) -> Column:
    """Visible text, the title and the contents of the meta tags."""
    metas = F.regexp_extract_all(page, F.lit(r"""(?i)<meta\b[^>]*\bcontent\s*=\s*["']([^"']*)["']"""), F.lit(1))
    return F.concat_ws(" ", html.visible(page), html.title(page), F.array_join(metas, " "))


def same_site(a: Column, b: Column) -> Column:
    """Whether two hosts are one site: equal, or one under the other."""
    a, b = urls.ascii_host(urls.host(a)), urls.ascii_host(urls.host(b))
    return (a != "") & (b != "") & ((a == b) | a.endswith(F.concat(F.lit("."), b)) | b.endswith(F.concat(F.lit("."), a)))


def places(x: Column, word: Column) -> Column:
    """Starts (from 0) of all occurrences of a word in a text."""
    parts = F.split(x, F.concat(F.lit("\\Q"), word, F.lit("\\E")), -1)
    step = lambda acc, p: F.struct((acc["at"] + F.length(p) + F.length(word)).alias("at"), F.array_append(acc["out"], acc["at"] + F.length(p)).alias("out"))
    out = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)["out"]
    return F.when(F.coalesce(word, F.lit("")) == "", F.array().cast("array<int>")).otherwise(fixed.let(out, lambda o: F.slice(o, F.lit(1), F.greatest(F.size(o) - 1, F.lit(0)))))


def address_places(x: Column, email: Column) -> Column:
    """Starts of the address as a whole one, not as a part of another."""
    return F.filter(places(x, email), lambda p: ~F.substring(x, p, F.lit(1)).rlike(r"[\w.+-]") & ~F.substring(x, p + F.length(email) + 1, F.lit(1)).rlike(r"[\w-]") | (p == 0) & ~F.substring(x, F.length(email) + 1, F.lit(1)).rlike(r"[\w-]"))


def on_text(x: Column, email: Column, body) -> Column:
    """body(text, small address) with both computed once for a row, whatever the number of places."""
    return fixed.let(F.struct(x.alias("x"), F.lower(email).alias("e")), lambda v: body(v["x"], v["e"]))


def distance(page: Column, email: Column, word: Column, within: int = WINDOW) -> Column:
    """Characters between the address and the word where they stand closest on a page; null if never within reach."""

    def closest(v: Column) -> Column:
        gaps = F.flatten(F.transform(v["at"], lambda p: F.transform(v["to"], lambda q: F.when(q >= p, q - p - v["e"]).otherwise(p - q - v["w"]))))
        return F.array_min(F.filter(gaps, lambda g: g.between(0, within)))

    def found(x: Column, e: Column) -> Column:
        return fixed.let(folded(word), lambda w: fixed.let(F.struct(address_places(x, e).alias("at"), places(x, w).alias("to"), F.length(e).alias("e"), F.length(w).alias("w")), closest))

    return on_text(folded(contact_text(page)), email, found)


def is_labelled(page: Column, email: Column, label: Column, within: int = WINDOW) -> Column:
    around = lambda x, e, p: F.substring(x, F.greatest(p - within, F.lit(0)) + 1, F.length(e) + 2 * within)
    return on_text(F.lower(html.visible(page)), email, lambda x, e: F.exists(address_places(x, e), lambda p: around(x, e, p).contains(F.lower(label))))


def is_printed(page: Column, email: Column) -> Column:
    return on_text(folded(html.visible(page)), email, lambda x, e: F.size(address_places(x, e)) > 0)


def is_on_page(page: Column, email: Column) -> Column:
    return on_text(F.lower(html.unescaped(page)), email, lambda x, e: F.size(address_places(x, e)) > 0)


def uses_mail_domain(page: Column, email: Column) -> Column:
    """Whether the page has another address on the same mail domain."""
    found = F.array_except(F.regexp_extract_all(F.lower(page), F.lit(f"({fixed.EMAIL})"), F.lit(1)), F.array(F.lower(email)))
    return F.exists(found, lambda x: F.substring_index(x, "@", -1) == F.lower(F.substring_index(email, "@", -1)))


def lead_problems(rows: DataFrame, pages: DataFrame, mx: DataFrame | None = None) -> DataFrame:
    """rows (row, site, email, surname, title, label, signal, source_url) with `problems`, all of them, by the page
    snapshots (url, html) and, where known, mail hosts (host, has_mx)."""
    x = rows.join(pages.select(F.col("url").alias("source_url"), "html"), "source_url", "left").withColumn("host", F.lower(F.substring_index("email", "@", -1)))
    x = x.join(F.broadcast(mx), "host", "left") if mx is not None else x.withColumn("has_mx", F.lit(None).cast("boolean"))
    page, email = F.col("html"), F.col("email")
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    checks = [
        ("no page", page.isNull()), ("address not on page", ~is_on_page(page, email)), ("address only in markup", is_on_page(page, email) & ~is_printed(page, email)),
        ("source on another site", ~same_site(F.col("source_url"), F.col("site"))), ("mail of another site", ~same_site(email, F.col("site")) & ~uses_mail_domain(page, email)),
        ("free mailbox", urls.is_free_mail(F.col("host"))), ("no mail server", ~F.col("has_mx")), ("name not beside address", some("surname") & distance(page, email, F.col("surname")).isNull()),
        ("title not beside address", some("title") & distance(page, email, F.col("title")).isNull()), ("label not beside address", some("label") & ~is_labelled(page, email, F.col("label"))),
        ("signal not on page", some("signal") & ~F.contains(folded(signal_text(page)), folded(F.col("signal")))),
    ]
    return x.withColumn("problems", R.all_failed(checks)).drop("html", "host", "has_mx")


def robots_summary(files: DataFrame) -> DataFrame:
    """One row: hosts with rules, without a file, and without an answer, by their state (rules, open, closed)."""
    return files.agg(*[F.count_if(F.col("state") == s).alias(n) for s, n in (("rules", "with_rules"), ("open", "no_file"), ("closed", "down"))])


# --- enrichment


def months_old(date: Column, as_of: datetime.date) -> Column:
    """Whole months from YYYY or YYYY-MM; a bare year counts from January."""
    y, m = F.regexp_extract(date, r"^(\d{4})", 1).cast("int"), F.regexp_extract(date, r"^\d{4}-(\d{2})", 1)
    return (F.lit(as_of.year) - y) * 12 + F.lit(as_of.month) - F.when(m == "", 1).otherwise(F.try_to_number(m, F.lit("99")).cast("int"))


def plain_words(x: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(x), r"(?U)\s+"), lambda w: F.regexp_replace(w, r"(?U)^[\p{Punct}«»“”„…–—]+|[\p{Punct}«»“”„…–—]+$", "")), lambda w: w != "")


def is_run_of(short: Column, full: Column) -> Column:
    """Whether the words of one text stand in the other side by side and in order."""
    s, f = plain_words(short), plain_words(full)
    return (F.size(s) > 0) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(f), F.lit(1))), lambda i: F.slice(f, i, F.size(s)) == s)


def priority(lead_type: Column, event: Column, segment: Column, named: Column, by_name: Column) -> Column:
    """A for an event in sales (written to by name, or a lead); B for another event, a named person or box;
    else C."""
    is_lead, sales = F.coalesce(lead_type, F.lit("")) != "", segment == "sales"
    return F.when(event & sales & (is_lead | by_name), "A").when(event | F.when(is_lead, lead_type == "named").otherwise(named), "B").otherwise("C")


def contact_level(named: Column, address_confirmed: Column, by_name: Column) -> Column:
    """level (A: the person's address is confirmed, B: a person is named, C: none is) and the letter's variant."""
    level = F.when(named & address_confirmed, "A").when(named, "B").otherwise("C")
    return F.struct(level.alias("level"), F.when(named & by_name, F.when(level == "A", "c").otherwise("b")).otherwise("a").alias("variant"))


def name_use(date: Column, as_of: datetime.date, backed: Column) -> Column:
    """A name of 24 months or more is dropped unless a standing page backs it, one of 12 or more is not
    written to by name."""
    age = months_old(date, as_of)
    return F.when((age >= 24) & ~backed, "dropped").when(age >= 12, "kept").otherwise("addressed")


def first_keyword(title: Column, groups: list[tuple[str, list[str]]]) -> Column:
    """The first group one of whose keywords is in the title; null if none is."""
    low, out = F.lower(title), F.lit(None).cast("string")
    for name, words in reversed(groups):
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


# --- letters


def options(template: Column, longest: bool = True) -> Column:
    """The template with each {{RANDOM a,b,...}} as its longest option by words (the shortest, if not longest)."""
    blocks = F.regexp_extract_all(template, F.lit(RANDOM), F.lit(1))
    rank = lambda o: text.words_at_bytes(o) * (1 if longest else -1)
    pick = lambda b: F.array_max(F.transform(F.split(b, ","), lambda o, i: F.struct(rank(F.trim(o)).alias("n"), (-i).alias("i"), F.trim(o).alias("o"))))["o"]
    return _filled(template, blocks, pick)


def greeted(template: Column, key: Column, step: Column, seed: str) -> Column:
    """The template with each {{RANDOM ...}} as the option that a hash of the contact and the step picks."""
    blocks = F.regexp_extract_all(template, F.lit(RANDOM), F.lit(1))
    number = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), key, step.cast("string")), 256), 1, 7), 16, 10).cast("int")
    return _filled(template, blocks, lambda b: F.trim(F.element_at(F.split(b, ","), F.pmod(number, F.size(F.split(b, ","))) + 1)))


def _filled(template: Column, blocks: Column, pick: Callable[[Column], Column]) -> Column:
    between = F.split(template, RANDOM, -1)
    rest = F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0)))
    return F.concat(F.element_at(between, 1), F.array_join(F.zip_with(blocks, rest, lambda b, r: F.concat(pick(b), r)), ""))


def rendered(template: Column, values: Column) -> Column:
    """The template with {{name}} as its value in the map; a name that the map lacks stays."""
    return F.aggregate(F.map_entries(values), template, lambda acc, e: F.replace(acc, F.concat(F.lit("{{"), e["key"], F.lit("}}")), F.coalesce(e["value"], F.lit(""))))


def variables(template: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(template, F.lit(VARIABLE), F.lit(1)), lambda v: ~v.startswith("RANDOM")))


def letters(contacts: DataFrame, steps: DataFrame, seed: str) -> DataFrame:
    """contacts (contact, variant, values map) x steps (step, variant or null for all, subject, body): the rendered letters
    with their words. Templates are a handful of rows, so they go to every task."""
    x = contacts.join(F.broadcast(steps.withColumnRenamed("variant", "of")), F.col("of").isNull() | (F.col("of") == F.col("variant")))
    first = F.first_value(F.nullif("subject", F.lit("")), True).over(Window.partitionBy("contact").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    subject = F.when(F.coalesce("subject", F.lit("")) == "", F.concat(F.lit("Re: "), first)).otherwise(F.col("subject"))
    done = x.withColumn("subject", subject).withColumns({c: rendered(greeted(F.col(c), F.col("contact").cast("string"), F.col("step"), seed), F.col("values")) for c in ("subject", "body")})
    return done.select("contact", "step", "subject", "body", (text.words_at_bytes(F.col("subject")) + text.words_at_bytes(F.col("body"))).alias("words"))


def letter_problems(rendered_letters: DataFrame, limit: int = 120, placeholders: tuple[str, ...] = ()) -> DataFrame:
    both = F.concat_ws("\n", "subject", "body")
    bare = both
    for p in placeholders:
        bare = F.replace(bare, F.lit(p), F.lit(""))
    checks = [("empty", (F.trim("subject") == "") | (F.trim("body") == "")), ("variables left", both.contains("{{") | both.contains("}}")), ("brackets", bare.rlike(r"\[[^\]]*\]")), ("too long", F.col("words") > limit)]
    return rendered_letters.withColumn("problems", R.all_failed(checks))


def batches(contacts: DataFrame, sizes: list[tuple[str, int]], order: list, hands: list[str]) -> DataFrame:
    """Contacts with the batch they fill, in order of the sizes (null beyond them), and the mailbox by turns."""
    x = contacts.withColumn("_n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))  # a campaign is some hundred rows
    batch, upto = F.lit(None).cast("string"), 0
    bounds = []
    for name, size in sizes:
        bounds.append((name, upto, upto + size))
        upto += size
    for name, lo, hi in reversed(bounds):
        batch = F.when(F.col("_n").between(lo + 1, hi), name).otherwise(batch)
    return x.withColumns({"batch": batch, "mailbox": F.element_at(F.array(*map(F.lit, hands)), (F.pmod(F.col("_n") - 1, F.lit(len(hands))) + 1).cast("int"))}).drop("_n")


def export_problems(contacts: DataFrame, sizes: list[tuple[str, int]], required: list[str]) -> DataFrame:
    """problem, key: repeated addresses, malformed ones, empty fields, batches of the wrong size, mailboxes and arms out of
    balance. contacts: email, stratum, arm, batch, mailbox and the required columns."""
    each = R.all_failed([("malformed", ~F.col("email").rlike(f"^{fixed.java(fixed.EMAIL)}$")), ("no batch", F.col("batch").isNull()), *[(f"empty {c}", F.coalesce(F.col(c), F.lit("")) == "") for c in required]])
    rows = contacts.select(F.explode(each).alias("problem"), F.col("email").alias("key"))
    twice = contacts.groupBy(F.lower("email").alias("key")).count().filter("count > 1").select(F.lit("repeated").alias("problem"), "key")
    total = contacts.count()
    wanted, left = [], total
    for name, size in sizes:
        wanted.append((name, min(size, left)))
        left -= wanted[-1][1]
    spark = contacts.sparkSession
    sized = spark.createDataFrame(wanted, "key string, wanted long").join(contacts.groupBy(F.col("batch").alias("key")).count(), "key", "left").filter(F.coalesce("count", F.lit(0)) != F.col("wanted")).select(F.lit("batch size").alias("problem"), "key")
    spread = lambda by, over, name: contacts.groupBy(by, over).count().groupBy(by).agg((F.max("count") - F.when(F.count("*") > 1, F.min("count")).otherwise(0)).alias("d")).filter("d > 1").select(F.lit(name).alias("problem"), F.col(by).alias("key"))
    return rows.unionByName(twice).unionByName(sized).unionByName(spread("batch", "mailbox", "mailboxes")).unionByName(spread("stratum", "arm", "arms"))


def structure_problems(bodies: DataFrame, limit_lines: int = 3) -> DataFrame:
    """bodies (letter, step, body) with problems of form: links or lists in the text, questions, paragraphs."""
    body = F.col("body")
    paragraphs = F.filter(F.split(body, r"\n\s*\n"), lambda p: F.trim(p) != "")
    last = F.element_at(paragraphs, -1)
    checks = [
        ("link", body.rlike(r"(?i)https?://|www\.")), ("list", body.rlike(r"(?m)^\s*(?:[-*•]|\d+[.)])\s")), ("no question", ~body.contains("?")), ("one paragraph", F.size(paragraphs) < 2),
        ("long signature", F.size(F.split(last, "\n")) > limit_lines), ("double space", body.rlike(r"[^\n ]  +[^ ]")),
    ]
    return bodies.withColumn("problems", R.all_failed(checks))


# --- documents against tables


def fenced_blocks(lines: DataFrame) -> DataFrame:
    """doc, block, heading, text of the fenced blocks of Markdown lines (doc, place, line): a fence's parity says whether a
    line is inside."""
    w = Window.partitionBy("doc").orderBy("place")
    fence = F.col("line").rlike(r"^\s*```")
    x = lines.withColumns({"fences": F.sum(F.when(fence, 1).otherwise(0)).over(w), "fence": fence})
    x = x.withColumn("heading", F.last(F.when(F.col("line").rlike(r"^#+\s") & (F.col("fences") % 2 == 0), F.trim(F.regexp_replace("line", r"^#+\s*", ""))), True).over(w))
    inner = x.filter("fences % 2 = 1 and not fence")
    block = F.floor((F.col("fences") + 1) / 2)
    return inner.groupBy("doc", block.alias("block")).agg(F.max("heading").alias("heading"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda s: s["line"]), "\n").alias("text"))


def section(markdown: Column, title: str) -> Column:
    return F.regexp_replace(F.regexp_extract(markdown, rf"(?ms)^#+\s*\Q{title}\E\s*$(.*?)(?=^#+\s|\z)", 1), r"^\s+|\s+$", "")


def line_differences(documents: DataFrame, tables: DataFrame, key: str = "letter") -> DataFrame:
    """key, side, line: lines that only the document or only the table has (both: key, text)."""
    lines = lambda df: df.select(key, F.explode(F.array_distinct(F.filter(F.transform(F.split("text", "\n"), lambda v: F.trim(v)), lambda x: x != ""))).alias("line"))
    d, t = lines(documents), lines(tables)
    return d.subtract(t).withColumn("side", F.lit("document")).unionByName(t.subtract(d).withColumn("side", F.lit("table")))


def missing_sentences(documents: DataFrame, sentences: DataFrame) -> DataFrame:
    """doc, name of sentences (doc, name, text) that their document (doc, text) does not hold, spaces aside."""
    d = documents.select("doc", text.collapsed(F.col("text")).alias("body"))
    return sentences.join(d, "doc", "left").filter(~F.contains(F.coalesce("body", F.lit("")), text.collapsed(F.col("text")))).select("doc", "name")


def paragraph_differences(a: Column, b: Column) -> Column:
    """Numbers (from 1) of the paragraphs in which two texts differ."""
    p = lambda x: F.filter(F.split(x, r"\n\s*\n"), lambda q: F.trim(q) != "")
    return F.filter(F.zip_with(F.transform(p(a), lambda x, i: F.struct((i + 1).alias("n"), x.alias("t"))), p(b), lambda x, y: F.when(~x["t"].eqNullSafe(y), x["n"])), lambda n: n.isNotNull())


def counts_line(df: DataFrame, column: str, order: list[str] | None = None) -> DataFrame:
    """One row: the values of a column with their counts, in the given order or from the commonest."""
    g = df.groupBy(column).count()
    place = F.array_position(F.array(*map(F.lit, order)), F.col(column)) if order else -F.col("count")
    row = F.struct(place.alias("p"), F.col(column).alias("v"), F.col("count").alias("n"))
    return g.agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat(x["v"], F.lit(" "), x["n"].cast("string"))), ", ").alias("line"))


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """The Russian form of a noun after a number."""
    return F.when((n % 10 == 1) & (n % 100 != 11), one).when((n % 10).between(2, 4) & ~(n % 100).between(12, 14), few).otherwise(many)


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """stage, n: rows that pass each stage and all before it, in one pass."""
    passed, out = F.lit(True), []
    for name, cond in stages:
        passed = passed & F.coalesce(cond, F.lit(False))
        out.append((name, F.count_if(passed)))
    row = df.agg(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(name).alias("stage"), n.alias("n")) for i, (name, n) in enumerate(out)]).alias("a"))
    return row.select(F.explode("a").alias("x")).select("x.*")


def longest_value(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, value: the longest value by words of each column, the first of equals in their order."""
    flat = df.unpivot([], columns, "variable", "value").filter("value is not null and value <> ''")
    return flat.groupBy("variable").agg(F.max_by("value", F.struct(text.words_at_bytes(F.col("value")).alias("n"), F.col("value").alias("v"))).alias("value"))
