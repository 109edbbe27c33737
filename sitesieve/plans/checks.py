"""Does a row's site and address belong to the company it names? Rows are (row, company, site, email); pages are page
records of their sites. Levels: 2 mismatch, 1 review, 0 a note."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitesieve.functions import fixed, fuzzy, text, urls


def level(n: Column | int, code: Column | str, detail: Column | None = None) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(n).alias("level"), lit(code).alias("code"), F.coalesce(detail, F.lit("")).alias("detail") if detail is not None else F.lit("").alias("detail"))


def status(issues: Column) -> Column:
    """The label of the worst issue."""
    worst = F.array_max(F.transform(issues, lambda x: x["level"]))
    return F.when(worst == 2, "MISMATCH").when(worst == 1, "REVIEW").otherwise("OK")


def comment(issues: Column) -> Column:
    """Distinct codes, the worst first."""
    rank = F.array_sort(F.transform(issues, lambda x: F.struct((-x["level"]).alias("l"), x["code"].alias("c"))))
    return F.array_join(F.array_distinct(F.transform(rank, lambda x: x["c"])), "; ")


def brand_of(home: Column, name: Column, domain: Column) -> Column:
    """Whom a site says it is: its name (the first that a page gives), the parts of its title that say something, a logo or
    a copyright line. home: the first page's title, logos and copyright."""
    parts = F.filter(F.split(home["title"], r"\s[|–—:-]\s|\|"), lambda s: (F.trim(s) != "") & ~F.trim(s).rlike(fixed.java(fixed.GENERIC_TITLE)))
    marks = F.filter(F.concat(home["logos"], home["copyright"]), lambda s: ~s.rlike(fixed.java(fixed.GENERIC_TITLE)))
    brand = F.coalesce(name, F.nullif(F.array_join(F.transform(parts, lambda v: F.trim(v)), " – "), F.lit("")), F.try_element_at(marks, F.lit(1)), domain)
    return F.left(brand, F.lit(70))


def zones(pages: DataFrame) -> DataFrame:
    """domain, zone, value, home, name: the distinct runs of text of a site, and once with zone null what brand_of() asks for. A run
    stands where the site names itself (STRONG) or in its text (BODY); GLUED are the sound keys of a page's strong text. So
    a site is as large as its vocabulary, in many rows, and a page is parsed once."""
    core = urls.core(urls.host(F.col("url")))
    strong = F.concat_ws(" ", F.replace(core, F.lit("-"), F.lit(" ")), F.replace(core, F.lit("-"), F.lit("")), "page.title", "page.site_name", F.array_join("page.logos", " "), F.array_join(F.slice("page.h1", 1, 2), " "), F.array_join("page.copyright", " "))
    body = F.concat_ws("\n", "page.description", F.left(F.array_join("page.lines", "\n"), F.lit(8000)))
    home = F.struct("place", "page.title", "page.logos", "page.copyright", F.nullif("page.site_name", F.lit("")).alias("name"))
    values = F.concat(F.array(F.struct(F.lit(None).cast("int").alias("zone"), F.lit(None).cast("string").alias("value"))), fuzzy.zone_values(strong, body))
    each = pages.select("domain", home.alias("home"), F.explode(values).alias("v")).select("domain", "v.*", F.when(F.col("v.zone").isNull(), F.col("home")).alias("home"))
    page = F.min_by(F.struct("home.title", "home.logos", "home.copyright"), "home.place")
    name = F.min_by("home.name", F.when(F.col("home.name").isNotNull(), F.col("home.place")))
    return each.groupBy("domain", "zone", "value").agg(page.alias("home"), name.alias("name"))


def brand_checked(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """row, issues: whether a site is its company's. rows: row, company, domain; pages: domain, place, url, page.

    Whose it is else comes from other rows: their names meet the site's on their sound keys, so no pair of all rows is made."""
    sites, is_home = zones(pages), F.col("home").isNotNull() | F.col("name").isNotNull()  # both readers ask for the same columns and filter after the groups, so that Spark makes these once
    asked = rows.select("domain", F.explode(text.name_words(F.col("company"))).alias("word")).distinct()
    named = sites.filter(~is_home).join(asked, "domain").filter(fuzzy.stands_in("word", "value", "zone")).groupBy("domain", "word").agg(F.min("zone").alias("zone"))
    known = sites.filter(is_home).select("domain", brand_of(F.col("home"), F.col("name"), F.col("domain")).alias("brand"))
    companies = rows.select("domain", "company").distinct()
    where = companies.withColumn("word", F.explode(text.name_words(F.col("company")))).join(named, ["domain", "word"]).groupBy("domain", "company").agg(F.min("zone").alias("zone"))
    x = companies.join(known, "domain", "left").join(where, ["domain", "company"], "left")
    x = x.withColumns({"words": text.name_words(F.col("company")), "by_domain": fuzzy.name_fits_domain(F.col("company"), urls.core(F.col("domain")))})
    x = rows.select("row", "domain", "company").join(x.withColumnsRenamed({"domain": "d", "company": "c"}), F.col("domain").eqNullSafe(F.col("d")) & F.col("company").eqNullSafe(F.col("c")), "left").join(owners(rows), "row", "left")
    unread = F.col("brand").isNull()
    ideographs = F.col("brand").rlike(fixed.CJK) & ~F.col("brand").rlike("(?i)[a-z]{3,}") & ~F.col("company").rlike(fixed.CJK)
    issue = (
        F.when(F.size("words") == 0, level(1, "no name"))
        .when(unread & F.col("by_domain"), level(1, "by domain only")).when(unread & F.col("owner").isNotNull(), level(2, "domain of another row", F.col("owner")))
        .when(unread, level(1, "site unread")).when(F.coalesce(F.col("zone") < fuzzy.BODY, F.lit(False)), level(0, "named by its site")).when(F.coalesce(F.col("zone") == fuzzy.BODY, F.lit(False)), level(1, "named in text only", F.col("brand")))
        .when(F.col("owner").isNull() & ideographs, level(1, "ideographs only")).otherwise(level(2, "another company's site", F.coalesce("owner", "brand")))
    )
    return x.select("row", F.array(issue).alias("issues"))


def owners(rows: DataFrame) -> DataFrame:
    """row, owner: for each row the first other company whose name fits the row's domain. Pairs come from the sound keys of
    name words and of the domain's parts, glued or not, and are then judged in full.

    Distinct names meet distinct brands of domains. A brand keeps its first name and its first one that differs from that:
    one of the two is each row's."""
    key, same = text.squashed, F.lower(F.trim("named"))
    named = rows.groupBy(F.col("company").alias("named")).agg(F.min("row").alias("other"))
    words = named.select("named", "other", F.explode(F.array_distinct(text.name_words(F.col("named")))).alias("w")).withColumn("key", key(F.col("w")))
    cores = rows.select(urls.core(F.col("domain")).alias("core")).distinct()
    parts = cores.select("core", F.explode(F.array_distinct(F.concat(F.split("core", "-"), F.array(F.replace(F.col("core"), F.lit("-"), F.lit("")))))).alias("p")).withColumn("key", key(F.col("p")))
    pairs = parts.join(words, "key").select("core", "other", "named").distinct().filter(fuzzy.name_fits_domain(F.col("named"), F.col("core")))
    spelled = pairs.groupBy("core", same.alias("name")).agg(F.min("other").alias("other"), F.min_by("named", "other").alias("named"))
    two = spelled.groupBy("core").agg(F.min_by(F.struct("name", "named"), "other").alias("a"), F.min("other").alias("first"))
    second = spelled.join(two.select("core", "first"), "core").filter("other <> first").groupBy("core").agg(F.min_by("named", "other").alias("b"))
    mine = rows.select("row", F.lower(F.trim("company")).alias("name"), urls.core(F.col("domain")).alias("core")).join(two.join(second, "core", "left"), "core")
    return mine.select("row", F.when(F.col("name") != F.col("a.name"), F.col("a.named")).when(F.col("name") == F.col("a.name"), F.col("b")).alias("owner")).filter("owner is not null")


def mailbox_facts(pages: DataFrame) -> DataFrame:
    """domain, printed (all addresses and hosts of a site's pages, in small letters), boxes (its first five role boxes)."""
    html = F.lower("html")
    found = F.regexp_extract_all(html, F.lit(f"({fixed.EMAIL})"), F.lit(1))
    each = pages.select("domain", "place", F.posexplode(found).alias("i", "email"), F.lit(True).alias("x"))
    role = F.substring_index("email", "@", 1).rlike(fixed.java(fixed.ROLE_MAILBOX)) & ~F.col("email").rlike(r"\.(png|jpe?g|gif|svg|webp|js|css)$")
    first = each.groupBy("domain", "email").agg(F.min(F.struct("place", "i")).alias("at"), F.first(role).alias("role"))
    return first.groupBy("domain").agg(F.collect_set("email").alias("printed"), F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("role"), F.struct("at", "email")))), lambda s: s["email"]), 1, 5).alias("boxes"))


def email_checked(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """row, issues: whether an address fits its row's site, or an alias that the site prints."""
    first = F.lower(F.trim(F.regexp_extract(F.trim("email"), r"^[^,; ]*", 0)))
    hosts = pages.groupBy("domain").agg(F.collect_set(urls.registrable(urls.host(F.col("url")))).alias("sites"), F.max(F.lit(True)).alias("read"))
    x = rows.withColumns({"e": first, "domain": urls.host(F.col("domain"))}).join(mailbox_facts(pages), "domain", "left").join(hosts, "domain", "left")
    x = x.withColumns({"host": F.substring_index("e", "@", -1), "reg": urls.registrable(F.substring_index("e", "@", -1)), "own": urls.registrable(F.col("domain"))})
    none = F.expr("cast(array() as array<string>)")
    printed, boxes = F.coalesce("printed", none), F.coalesce("boxes", none)
    here, same = F.array_contains(printed, F.col("e")), (F.col("reg") == F.col("own")) | F.array_contains(F.coalesce("sites", none), F.col("reg"))
    typo = F.exists(boxes, lambda b: (urls.registrable(F.substring_index(b, "@", -1)) == F.col("reg")) & text.is_typo(F.substring_index(F.col("e"), "@", 1), F.substring_index(b, "@", 1)))
    alias = F.exists(printed, lambda p: (F.substring_index(p, "@", -1) == F.col("host")) | (urls.registrable(F.substring_index(p, "@", -1)) == F.col("reg")))
    bare = lambda c: F.replace(urls.core(c), F.lit("-"), F.lit(""))
    parts = lambda c: F.filter(F.split(urls.core(c), "[-_]"), lambda p: F.length(p) >= 4)
    free = F.col("reg").isin(*fixed.FREE_MAIL)
    issue = (
        F.when(F.coalesce("e", F.lit("")) == "", level(0, "no address")).when(~F.col("e").rlike(f"^{fixed.java(fixed.EMAIL)}$"), level(2, "no address by its form"))
        .when((F.col("own") == "") & free, level(2, "free mailbox")).when(F.col("own") == "", level(0, "no site to compare")).when(free & here, level(1, "free mailbox, printed")).when(free, level(2, "free mailbox"))
        .when(same & here, level(0, "printed")).when(same & typo, level(1, "a like address is printed")).when(same, level(0, "own domain")).when(alias, level(0, "alias the site prints"))
        .when(bare(F.col("reg")) == bare(F.col("own")), level(1, "spelled otherwise")).when(F.arrays_overlap(parts(F.col("reg")), parts(F.col("own"))), level(1, "shares a part")).otherwise(level(2, "another domain"))
    )
    return x.select("row", F.array(issue).alias("issues"))


def cross_row(rows: DataFrame) -> DataFrame:
    """row, issues: rows whose site or address another row has too: a mismatch if one of these names another company.

    A group is aggregated, not joined with itself, so that a site of many rows gives no pairs."""
    keyed = rows.select("row", F.lower(F.trim("company")).alias("name"), F.explode(F.array(
        F.struct(F.lit("site").alias("what"), F.nullif(urls.registrable(urls.host(F.col("domain"))), F.lit("")).alias("key")),
        F.struct(F.lit("email").alias("what"), F.nullif(F.lower(F.trim("email")), F.lit("")).alias("key")),
    )).alias("k")).select("row", "name", "k.*").filter("key is not null")
    groups = keyed.groupBy("what", "key").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.min("row").alias("first")).filter("n > 1")
    told = keyed.join(groups, ["what", "key"]).select("row", level(F.when(F.col("names") > 1, 2).otherwise(1), F.concat(F.lit("same "), "what"), F.col("first").cast("string")).alias("issue"))
    return told.groupBy("row").agg(F.sort_array(F.collect_list("issue")).alias("issues"))


def hints(rows: DataFrame) -> DataFrame:
    """row, owner: for rows whose name does not fit their own domain, the other company that it fits."""
    odd = rows.filter(~fuzzy.name_fits_domain(F.col("company"), urls.core(F.col("domain"))))
    return owners(rows).join(odd.select("row"), "row", "left_semi")


def checked(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """row, status, comment: all checks of each row together."""
    parts = [brand_checked(rows, pages), email_checked(rows, pages), cross_row(rows)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("row").agg(F.flatten(F.collect_list("issues")).alias("issues"))
    return every.select("row", status(F.col("issues")).alias("status"), comment(F.col("issues")).alias("comment"))
