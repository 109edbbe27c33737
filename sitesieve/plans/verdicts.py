"""From candidates to leads: the context of each site, the ordered checks of each candidate, and the reduction per company.

All of it is expressions, joins and aggregates; reasons are short codes, with the stage a candidate got to.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitesieve.functions import dates, fixed, fuzzy, people, text, urls

#: Roles in their default order, and boxes in the order in which they stand for a company.
ROLES = ("commercial", "sales", "marketing", "bizdev", "ceo")
BOXES = ("sales", "sale", "zakaz", "order", "opt", "sbyt", "commerce", "kp", "info", "mail", "office")


@dataclass(frozen=True)
class Rules:
    """Parameters of a run."""

    as_of: datetime.date
    roles: tuple[str, ...] = ROLES
    gap: int = 350
    least_confidence: int = 50
    mailto: str = "none"  # none, matched, card or all: when an address that is only a link's target counts
    freshness_months: int = 24
    leads_per_company: int = 3
    extra: dict = field(default_factory=dict)

    @property
    def day(self) -> Column:
        return F.lit(self.as_of)


def local(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def mail_host(email: Column) -> Column:
    return F.substring_index(email, "@", -1)


def site_facts(atoms: DataFrame, rules: Rules, key: str = "page_id") -> DataFrame:
    """A row per site of atoms (site, key, url, kind and the atom's fields): what its pages say of their age, size and
    wishes. updated: the latest "updated on" date of each page."""
    line = F.col("text")
    spans = dates.spans(line, rules.as_of)
    x = atoms.withColumns({"spans": spans, "tail": F.regexp_extract(line, f"{fixed.java(fixed.UPDATED)}(.{{0,40}})", 1)})
    past = F.filter(dates.days(F.col("spans")), lambda d: d <= rules.day)
    after = dates.spans(F.col("tail"), rules.as_of)
    feed = ~F.col("chrome") & F.length(line).between(6, 24) & (F.size("spans") == 1) & (F.try_element_at("spans", F.lit(1))["start"] <= 1) & (F.try_element_at("spans", F.lit(1))["stop"] >= F.length(line) - 3)
    x = x.withColumns({
        "day": F.array_max(past), "feed_day": F.when(feed & (F.col("kind") == "home"), F.array_max(past)),
        "updated": F.when(F.col("tail") != "", F.array_max(F.transform(F.filter(after, lambda s: (s["start"] <= 3) & (s["day"] <= rules.day)), lambda s: s["day"]))),
        "year": F.array_max(F.filter(F.transform(F.regexp_extract_all(line, F.lit(fixed.java(fixed.COPYRIGHT_YEAR)), F.lit(0)), lambda m: F.regexp_extract(m, r"(\d{4})\D*$", 1).cast("int")), lambda y: y <= rules.as_of.year)),
        "staff": F.array_max(F.transform(F.regexp_extract_all(line, F.lit(fixed.java(fixed.STAFF_COUNT)), F.lit(1)), lambda s: F.regexp_replace(s, r"\D", "").cast("int"))),
        "banned": line.rlike(fixed.java(fixed.PERSONAL_DATA_BAN)), "refused": line.rlike(fixed.java(fixed.REFUSAL)),
    })
    pages = x.groupBy("site", "url").agg(F.max("updated").alias("updated"))
    marks = pages.filter("updated is not null").groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("url", "updated"))).alias("updated"))
    facts = x.groupBy("site").agg(
        F.max("day").alias("last_day"), F.when(F.count("feed_day") >= 3, F.max("feed_day")).alias("feed_day"), F.max("year").alias("footer_year"), F.max("staff").alias("staff"),
        F.min(F.when(F.col("banned"), F.col("url"))).alias("ban_url"), F.min(F.when(F.col("refused"), F.col("url"))).alias("refusal_url"),
    )
    return facts.join(marks, "site", "left")


def mail_domains(candidates: DataFrame) -> DataFrame:
    """site, mail_site, why: mail domains other than the site's own that are its company's: spelled like it, in its
    header or footer, or (where no address is on its own) holding three addresses and three quarters of all."""
    boxes = candidates.select("site", "email", "chrome", urls.own_site(mail_host(F.col("email"))).alias("mail_site")).filter(~urls.is_free_mail(mail_host(F.col("email"))))
    per = boxes.groupBy("site", "mail_site").agg(F.count_distinct("email").alias("n"), F.max("chrome").alias("shown"))
    w = Window.partitionBy("site")
    per = per.withColumns({"total": F.sum("n").over(w), "prints_own": F.max(F.col("mail_site") == F.col("site")).over(w)})
    a, b = text.squashed(urls.core(F.col("mail_site"))), text.squashed(urls.core(F.col("site")))
    alike = (F.length(a) >= 4) & (F.length(b) >= 4) & (a.contains(b) | b.contains(a) | (fuzzy.ratio(a, b) >= 0.8))
    most = ~F.col("prints_own") & (F.col("n") >= 3) & (F.col("n") >= 0.75 * F.col("total"))
    why = F.when(alike, "spelled like the site").when(F.col("shown"), "in the header or footer").when(most, "most addresses")
    return per.filter("mail_site <> site").withColumn("why", why).filter("why is not null").select("site", "mail_site", "why")


def shared_boxes(candidates: DataFrame) -> DataFrame:
    """site, email: addresses that stand in the cards of several people: a team's."""
    own = candidates.filter("in_card and surname <> ''").select("site", "email", text.squashed(F.col("surname")).alias("who"))
    return own.groupBy("site", "email").agg(F.count_distinct("who").alias("n")).filter("n > 1").select("site", "email")


def in_context(candidates: DataFrame, companies: DataFrame, facts: DataFrame, suppressed: DataFrame | None = None, mx: DataFrame | None = None) -> DataFrame:
    """Candidates (site, ...) with what the checks ask of their company, site, mail domain and the opt-out list. mx: host,
    has_mx, where it is known."""
    c = candidates.withColumns({"host": mail_host(F.col("email")), "local": local(F.col("email"))}).withColumn("mail_site", urls.own_site(F.col("host")))
    c = c.join(companies.select("site", "company", F.col("domain").alias("company_domain")), "site", "left").join(facts, "site", "left")
    c = c.join(mail_domains(candidates), ["site", "mail_site"], "left").join(shared_boxes(candidates).withColumn("several", F.lit(True)), ["site", "email"], "left")
    chrome = candidates.filter("chrome").select("site", "email").distinct().withColumn("in_chrome", F.lit(True))
    numbered = candidates.filter(~F.col("chrome") & local(F.col("email")).rlike(r"^(?i:\d+[a-z]?|[a-z]?\d+)$")).groupBy("site").agg(F.count_distinct("email").alias("numbered"))
    c = c.join(chrome, ["site", "email"], "left").join(numbered, "site", "left")
    c = c.join(F.broadcast(mx), "host", "left") if mx is not None else c.withColumn("has_mx", F.lit(None).cast("boolean"))
    c = c.na.fill({"several": False, "in_chrome": False, "numbered": 0, "staff": 0, "footer_year": 0})
    if suppressed is None:
        return c.withColumns({"opted_out": F.lit(False), "person_out": F.lit(False)})
    keys = F.array(text.hashed(F.col("email")), text.hashed(F.col("host")), text.hashed(urls.registrable(F.col("host"))), text.hashed(F.col("mail_site")))
    person = text.person_hash(F.coalesce("surname", F.lit("")), F.coalesce("first", F.lit("")), urls.registrable(F.col("company_domain")))
    c = c.withColumns({"row": F.monotonically_increasing_id(), "person_hash": F.when(F.col("person_key").isNotNull(), person)})
    listed = suppressed.select(F.col("sha256")).distinct()
    own = c.select("site", "email", F.explode(keys).alias("sha256")).distinct().join(listed, "sha256", "left_semi").select("site", "email").distinct().withColumn("opted_out", F.lit(True))
    theirs = listed.select(F.col("sha256").alias("person_hash"), F.lit(True).alias("person_out"))
    return c.join(own, ["site", "email"], "left").join(theirs, "person_hash", "left").na.fill({"opted_out": False, "person_out": False}).drop("row", "person_hash")


def address_kind(c: DataFrame) -> Column:
    """free, generic, personal, role or unknown: the first rule that fits."""
    how, near = F.coalesce("agreement", F.lit("")), F.col("person_key").isNotNull() & ~F.col("chrome")
    number = F.regexp_replace("local", r"\D", "")
    numeric = F.col("local").rlike(r"^(?i:\d+[a-z]?|[a-z]?\d+)$")
    beside = F.exists(F.coalesce("digits", F.array().cast("array<string>")), lambda d: (d == number) | ((F.length(number) >= 7) & d.endswith(number)))
    return (
        F.when(urls.is_free_mail(F.col("host")), "free").when(F.col("several"), "generic").when(F.col("in_chrome") & ~((how != "") & near), "generic")
        .when(people.is_generic_box(F.col("local"), urls.core(F.col("host"))) & ~how.isin("surname", "first"), "generic").when(how != "", "personal")
        .when(people.is_post_box(F.col("local")), "role").when(numeric & (beside | (F.col("numbered") >= 3)), "role").otherwise("unknown")
    )


def stale(rules: Rules) -> Column:
    """Whether a page's own date, or a site whose feed, footer and dates have all stopped, is too old to trust."""
    old = lambda d: dates.whole_months(d, rules.day) > rules.freshness_months
    updated = F.try_element_at("updated", F.col("url"))
    stopped = old(F.col("feed_day")) & (F.col("footer_year") < rules.as_of.year - 1) & (F.col("last_day").isNull() | old(F.col("last_day")))
    return F.coalesce(F.when(updated.isNotNull(), old(updated)).otherwise(stopped), F.lit(False))


def old_footer(rules: Rules) -> Column:
    year = F.col("footer_year")
    return F.try_element_at("updated", F.col("url")).isNull() & (year > 0) & (year < rules.as_of.year - max(1, rules.freshness_months // 12))


def freshness_note(rules: Rules) -> Column:
    updated = F.try_element_at("updated", F.col("url"))
    return F.when(updated.isNotNull(), F.concat(F.lit("updated "), updated.cast("string"))).when(F.col("footer_year") > 0, F.concat(F.lit("footer "), F.col("footer_year").cast("string"))).when(
        F.col("last_day").isNotNull(), F.concat(F.lit("last date "), F.col("last_day").cast("string"))).otherwise("undated")


def judged(c: DataFrame, rules: Rules) -> DataFrame:
    """Candidates in their context with kind, role, deputy, confidence, reason (null: accepted) and stage: the first check
    that fails gives the reason; of those that pass, the confidence is a sum of terms between 0 and 100."""
    role = people.role(F.coalesce("title", F.lit("")), F.col("dept"))
    c = c.withColumns({"kind": address_kind(c), "r": role, "brand": text.name_words(F.col("company"))})
    organisation = F.trim(F.regexp_extract(F.coalesce("title", F.lit("")), fixed.java(fixed.ORGANISATION), 1))
    own_brand = fuzzy.any_token(F.array_append("brand", urls.core(F.col("company_domain"))), F.coalesce("title", F.lit("")), F.lit(True))
    c = c.withColumns({
        "other_org": (organisation != "") & (F.size("brand") > 0) & ~fuzzy.any_token("brand", organisation, F.lit(True)), "own_domain": F.col("mail_site") == F.col("site"),
        "foreign": F.coalesce("section", F.lit("")).rlike(fixed.java(fixed.FOREIGN_SECTION)) | (urls.path(F.col("url")).rlike(fixed.java(fixed.FOREIGN_PATH)) & ~own_brand),
    })
    hidden = {"none": F.lit(False), "matched": F.col("in_card") & (F.col("kind") == "personal"), "card": F.col("in_card"), "all": F.lit(True)}[rules.mailto]
    base = F.coalesce(*[F.when(F.col("method") == m, n) for m, n in (("card", 70), ("sequence+local", 62), ("llm", 62), ("sequence", 58), ("zip", 55))], F.lit(50))
    plus = lambda cond, n: F.when(cond, n).otherwise(0)
    total = (
        base + plus(F.col("has_mx"), 5) + F.when(F.col("kind") == "personal", 20).otherwise(5) + plus(F.col("title_adjacent"), 5) + plus(F.col("r.deputy"), -5)
        + plus(F.col("person_kind").isin("initials", "no_surname"), -15) + plus(~F.col("visible"), -10) + plus(F.col("gap") > 200, -5) + plus(F.col("other_org"), -15) + plus(old_footer(rules), -10)
    )
    c = c.withColumn("confidence", F.least(F.greatest(total, F.lit(0)), F.lit(100)))
    no_title = F.coalesce("title", F.lit("")) == ""
    checks = [
        ("SYNTAX", 0, ~F.col("email").rlike(f"^{fixed.java(fixed.EMAIL)}$") | F.col("email").contains("..") | (F.length("local") > 64)), ("OPTOUT", 0, F.col("opted_out")),
        ("MOBILE_BOX", 1, F.col("local").rlike(fixed.java(fixed.MOBILE))), ("FREE", 1, F.col("kind") == "free"), ("DOMAIN", 1, ~F.col("own_domain") & F.col("why").isNull()),
        ("GENERIC", 2, F.col("kind") == "generic"), ("NO_NAME", 2, F.col("person_key").isNull()), ("OPTOUT", 0, F.col("person_out")), ("UNMATCHED", 3, F.col("kind") == "unknown"),
        ("NO_TITLE", 3, no_title | (F.col("title_gap") > rules.gap)), ("NOT_DM", 3, F.col("r.role") == "staff"), ("ROLE", 4, ~F.col("r.role").isin(*rules.roles)),
        ("FOREIGN", 4, F.col("foreign") | (F.col("other_org") & ~F.col("own_domain"))), ("GAP", 5, F.col("gap") > rules.gap), ("MAILTO", 5, ~F.col("visible") & ~hidden),
        ("PD_BAN", 6, F.col("ban_url").isNotNull()), ("REFUSAL", 6, F.col("refusal_url").isNotNull()), ("STALE", 6, stale(rules)), ("NO_MX", 7, ~F.col("has_mx")),
        ("LOW", 8, F.col("confidence") < rules.least_confidence),
    ]
    verdict = F.coalesce(*[F.when(bad, F.struct(F.lit(reason).alias("reason"), F.lit(stage).alias("stage"))) for reason, stage, bad in checks], F.struct(F.lit(None).cast("string").alias("reason"), F.lit(9).alias("stage")))
    named = F.when((F.col("v.reason") == "NO_NAME") & (F.col("reason") == "AMBIGUOUS"), "AMBIGUOUS").otherwise(F.col("v.reason"))
    out = c.withColumn("v", verdict).withColumns({"reason": named, "stage": F.col("v.stage"), "role": F.col("r.role"), "deputy": F.col("r.deputy")})
    return out.drop("v", "r", "brand")


def per_address(verdicts: DataFrame, order: list[str]) -> DataFrame:
    """One verdict per site and address: the furthest, then the surest, then the first in `order`."""
    w = Window.partitionBy("site", "email").orderBy(F.desc("stage"), F.desc(F.when(F.col("stage") >= 8, F.col("confidence")).otherwise(0)), *order)
    return verdicts.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def leads(finals: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Leads of each site, one per person (a printed address before a linked one, then the surer), by role and confidence,
    leads_per_company at most; and per site and reason how many addresses were not taken."""
    good = finals.filter("reason is null")
    mine = Window.partitionBy("site", "person_key").orderBy(F.desc("visible"), F.desc("confidence"), "email")
    persons = good.withColumn("_n", F.row_number().over(mine))
    place = F.array_position(F.array(*map(F.lit, rules.roles)), F.col("role"))
    ranked = persons.filter("_n = 1").withColumn("rank", F.row_number().over(Window.partitionBy("site").orderBy(F.when(place == 0, 99).otherwise(place), F.desc("confidence"), "email")))
    kept = ranked.filter(F.col("rank") <= rules.leads_per_company).drop("_n")
    count = lambda df, reason: df.groupBy("site", reason.alias("reason")).agg(F.count("*").alias("n"))
    rejects = count(finals.filter("reason is not null"), F.col("reason")).unionByName(count(persons.filter("_n > 1"), F.lit("DUPLICATE"))).unionByName(count(ranked.filter(F.col("rank") > rules.leads_per_company), F.lit("LIMIT")))
    return kept, rejects


def general_box(finals: DataFrame) -> DataFrame:
    """site, contact: the box that stands for a company without a lead: by BOXES, one of its own domain before a free one
    that is named like a department or the company."""
    rank = F.coalesce(*[F.when(F.col("local").startswith(b), i) for i, b in enumerate(BOXES)], F.lit(len(BOXES)))
    named = people.is_generic_box(F.col("local"), urls.core(F.col("company_domain"))) | fuzzy.name_fits_domain(F.col("company"), F.col("local"))
    own, free = F.col("reason") == "GENERIC", (F.col("reason") == "FREE") & F.col("person_key").isNull() & named
    return finals.filter(own | free).groupBy("site").agg(F.min_by("email", F.struct((~own).alias("a"), rank.alias("b"), F.col("email").alias("c"))).alias("contact"))


def why_none(finals: DataFrame) -> DataFrame:
    """site, reason: what stopped the candidate that got furthest."""
    return finals.groupBy("site").agg(F.max_by("reason", F.struct("stage", "email")).alias("reason"), F.count_if(F.col("reason").isNull()).alias("good")).filter("good = 0").select("site", "reason")


def summary(results: DataFrame) -> DataFrame:
    """Counts by status, role, kind and reason in one pass of grouping sets: what, value, n."""
    g = results.groupingSets([["status"], ["role"], ["kind"], ["reason"], []], "status", "role", "kind", "reason").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    what = F.when(F.col("g") == 7, "status").when(F.col("g") == 11, "role").when(F.col("g") == 13, "kind").when(F.col("g") == 14, "reason").otherwise("all")
    return g.select(what.alias("what"), F.coalesce("status", "role", "kind", "reason").alias("value"), "n")


def summary_lines(summed: DataFrame) -> DataFrame:
    """line, text: a Markdown report of a summary, sections by name, values by count."""
    w = Window.orderBy("what", F.desc("n"), "value")  # a row per value: small
    return summed.filter("what <> 'all' and value is not null").select(F.row_number().over(w).alias("line"), F.concat(F.lit("- "), "what", F.lit(" / "), "value", F.lit(": "), F.col("n").cast("string")).alias("text"))
