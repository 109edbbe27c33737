"""Page records, atoms and mentions of a site's pages, the links worth following, and the lines that are its own."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitesieve.functions import dates, fixed, markup, text, urls
from sitesieve.operators import relational as R

GAP = "[…]"


def parsed(pages: DataFrame) -> DataFrame:
    """pages (url, html and others) with `page`, the record of each."""
    return pages.withColumn("page", markup.page("url", "html"))


def atom_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A row per atom of each page: key, and the fields of the atom."""
    return pages.select(key, F.explode(markup.atoms("url", "html")).alias("a")).select(key, "a.*")


def element_spans(atoms: DataFrame, key: str = "page_id") -> DataFrame:
    """key, element, lo, hi: the atoms each block spans, so that "inside the same card" is a join on the element."""
    return atoms.select(key, "number", F.explode("path").alias("element")).groupBy(key, "element").agg(F.min("number").alias("lo"), F.max("number").alias("hi"))


def inside(points: DataFrame, spans: DataFrame, on: list[str], at: str, lo: str = "lo", hi: str = "hi", width: int = 64) -> DataFrame:
    """Interval containment: points with the spans that hold them, by cells of `width`, so that it is an equi join."""
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    return points.withColumn("_cell", F.floor(F.col(at) / width)).join(cells, [*on, "_cell"]).filter(F.col(at).between(F.col(lo), F.col(hi))).drop("_cell")


def link_kind(path: Column, label: Column) -> Column:
    """kind (about, news) and score of a homepage's link, or null: the label says more than the path, cases come last."""
    label = text.collapsed(label)
    like = lambda x, p: x.rlike(fixed.java(p))
    news, about = like(label, fixed.NEWS_TEXT), like(label, fixed.ABOUT_TEXT)
    case = F.when(like(label, fixed.CASES) | like(path, fixed.CASES), 1).otherwise(0)
    score = lambda c, kind, n: F.when(c, F.struct(F.lit(kind).alias("kind"), (F.lit(n) - (case if kind == "news" else 0)).alias("score")))
    return F.coalesce(score(news, "news", 3), score(like(path, fixed.NEWS_PATH), "news", 2), score(about, "about", 3), score(like(path, fixed.ABOUT_PATH), "about", 2))


def page_kind(path: Column, label: Column) -> Column:
    """kind and score of a link by its path and label, the best of PAGE_KINDS; null for files and ordinary pages."""
    def one(kind: str, weight: int, of_path: str, of_label: str) -> Column:
        by_path, by_label = path.rlike(fixed.java(of_path)), F.coalesce(label.rlike(fixed.java(of_label)), F.lit(False))
        deeper = by_path & ~by_label & (F.regexp_replace(F.regexp_replace(path, f"{fixed.java('')}^.*?{of_path}", ""), "^/+|/+$", "") != "")
        value = F.lit(weight) + F.when(by_path & by_label, 1).when(deeper, -3).otherwise(0)
        fits = (by_path | by_label) & (~deeper if kind in ("about", "press") else F.lit(True))
        return F.when(fits, F.struct(value.alias("score"), F.lit(-weight).alias("order"), F.lit(kind).alias("kind")))

    best = F.array_max(F.array_compact(F.array(*[one(*k) for k in fixed.PAGE_KINDS])))
    return F.when(~path.rlike(fixed.java(fixed.SKIPPED_FILES)) & best.isNotNull(), F.struct(best["kind"].alias("kind"), best["score"].alias("score")))


def site_links(parsed_pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, place, link, path, label: links of each page to other pages of its site, in order; no files, no fragments."""
    each = parsed_pages.select(key, "url", F.posexplode("page.links").alias("place", "l")).select(key, "url", "place", F.col("l.href").alias("href"), F.col("l.text").alias("label"))
    clean = F.concat(F.regexp_extract("href", r"^https?://[^/?#]+", 0), F.when(urls.path(F.col("href")) == "", "/").otherwise(urls.path(F.col("href"))), F.regexp_extract("href", r"^[^?#]*(\?[^#]+)", 1))
    path = F.coalesce(F.try_url_decode(F.replace(urls.path(F.col("href")), F.lit("+"), F.lit("%2B"))), urls.path(F.col("href")))
    out = each.withColumns({"link": clean, "path": F.when(path == "", "/").otherwise(path)})
    same = urls.registrable(urls.host(F.col("href"))) == urls.registrable(urls.host(F.col("url")))
    known = out.filter(F.col("href").rlike("^https?://") & same & ~F.col("path").rlike(fixed.java(fixed.SKIPPED_FILES)))
    return known.filter(urls.comparable(F.col("link")) != urls.comparable(F.col("url"))).select(key, "place", "link", "path", "label")


def ranked_links(links: DataFrame, key: str = "page_id") -> DataFrame:
    """key, link, kind, score, rank: About and News links of each page, the best score of each, then the flatter path."""
    kind = link_kind(F.col("path"), F.col("label"))
    known = links.withColumn("k", kind).filter("k is not null").withColumn("depth", F.regexp_count(F.trim(F.col("path"), F.lit("/")), F.lit("/")))
    best = known.groupBy(key, "link").agg(F.max_by(F.struct(F.col("k.kind").alias("kind"), F.col("k.score").alias("score"), "depth", "place"), F.struct("k.score", -F.col("place"))).alias("b"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("b.score"), "b.depth", "b.place", "link"))
    return best.select(key, "link", F.col("b.kind").alias("kind"), F.col("b.score").cast("bigint").alias("score"), rank.alias("rank"))


def picked_links(ranked: DataFrame, limit: int, key: str = "page_id") -> DataFrame:
    """Quota top-k: the best About page, then News pages, then the rest, `limit` in all."""
    by_kind = F.row_number().over(Window.partitionBy(key, "kind").orderBy("rank"))
    tier = F.when((F.col("kind") == "about") & (F.col("n") == 1), 0).when((F.col("kind") == "news") & (F.col("n") <= max(1, limit - 1)), 1).when(F.col("kind") == "about", 2).otherwise(3)
    order = Window.partitionBy(key).orderBy("tier", "n")
    return ranked.withColumn("n", by_kind).withColumn("tier", tier).withColumn("pick", F.row_number().over(order)).filter(F.col("pick") <= limit).drop("n", "tier")


def contacts_link(links: DataFrame, key: str = "page_id") -> DataFrame:
    """key, link: the contacts page of each homepage: two points for the path, one for the label, the first of equals."""
    score = F.when(F.col("path").rlike(fixed.java(fixed.CONTACT_PATH)), 2).otherwise(0) + F.when(F.col("label").rlike(fixed.java(fixed.CONTACT_TEXT)), 1).otherwise(0)
    return R.argmax(links.withColumn("score", score).filter("score > 0"), [key], "link", [F.col("score"), -F.col("place")])


def content_hash(lines: Column) -> Column:
    return F.sha1(text.normal(F.array_join(lines, " ")).cast("binary"))


def distinct_pages(pages: DataFrame, site: str, order: str, url: str, digest: str) -> DataFrame:
    """Pages whose URL and text are both new among those kept before: a fold in order, as what is kept decides.

    A site's pages are few (its page budget), so a site is one row for the fold."""
    one = F.struct(F.col(order).alias("o"), F.col(url).alias("u"), F.col(digest).alias("d"))
    none = F.expr("cast(array() as array<string>)")
    start = F.struct(none.alias("us"), none.alias("ds"), F.array().cast(f"array<{pages.schema[order].dataType.simpleString()}>").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        seen = F.array_contains(acc["us"], x["u"]) | F.array_contains(acc["ds"], x["d"])
        return F.struct(F.when(seen, acc["us"]).otherwise(F.array_append(acc["us"], x["u"])).alias("us"), F.when(seen, acc["ds"]).otherwise(F.array_append(acc["ds"], x["d"])).alias("ds"), F.when(seen, acc["kept"]).otherwise(F.array_append(acc["kept"], x["o"])).alias("kept"))

    kept = pages.groupBy(site).agg(F.array_sort(F.collect_list(one)).alias("all")).select(site, F.explode(F.aggregate("all", start, step)["kept"]).alias(order))
    return pages.join(kept, [site, order], "left_semi")


def traversed(links: DataFrame, start: DataFrame, budget: int) -> DataFrame:
    """Best-first traversal of a link table (site, source, target, score): site, page, step. Each round takes the best
    unseen link of every site at once, so there are `budget` joins, whatever the number of sites."""
    reached = start.select("site", "page", F.lit(0).alias("step"))
    for step in range(1, budget):
        open_ = links.join(reached.select("site", F.col("page").alias("source")), ["site", "source"]).join(reached.select("site", F.col("page").alias("target")), ["site", "target"], "left_anti")
        best = R.argmax(open_.withColumn("page", F.col("target")), ["site"], "page", [F.col("score"), F.col("target")])
        reached = reached.unionByName(best.select("site", "page", F.lit(step).alias("step")))
    return reached


def line_rows(parsed_pages: DataFrame, site: str = "site", key: str = "page_id") -> DataFrame:
    return parsed_pages.select(site, key, F.posexplode("page.lines").alias("place", "line"))


def shared_lines(lines: DataFrame, site: str = "site", key: str = "page_id", least: int = 3) -> DataFrame:
    """site, line: lines of every page of a site of `least` pages or more."""
    return R.on_every(lines, site, key, "line", least).select(site, "line")


def content_lines(lines: DataFrame, as_of: datetime.date, site: str = "site", key: str = "page_id") -> DataFrame:
    """site, key, place, line: lines without the site-wide ones; a dated entry of all pages stays with its neighbours, and
    lines left out between two kept ones leave a GAP line (at the place of the last of them)."""
    common = shared_lines(lines, site, key).withColumn("common", F.lit(True))
    marked = lines.join(common, [site, "line"], "left").withColumn("entry", dates.entry_day(F.col("line"), dates.spans(F.col("line"), as_of)).isNotNull() & F.coalesce("common", F.lit(False)))
    w = Window.partitionBy(site, key).orderBy("place")
    near = F.col("entry") | F.coalesce(F.lag("entry").over(w), F.lit(False)) | F.coalesce(F.lead("entry").over(w), F.lit(False))
    kept = marked.withColumn("keep", F.col("common").isNull() | near)
    before = F.max(F.when(F.col("keep"), F.col("place"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ends = ~F.col("keep") & F.lead("keep").over(w) & before.isNotNull()
    return kept.withColumn("gap", ends).filter("keep or gap").select(site, key, "place", F.when(F.col("gap"), GAP).otherwise(F.col("line")).alias("line"))
