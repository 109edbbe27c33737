"""Robots rules (RFC 9309) as Column expressions and DataFrame steps.

A robots file has a bounded size, so its rules travel as one array a site; pages look them up by a join on the site and
judge them in place, with no row for each pair of a page and a rule.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sitesieve.functions import fixed, urls

# Keys of the lines that make rules, the characters that are never percent-encoded, and those that stay as
# they are where they stand bare.
DIRECTIVES = ("user-agent", "allow", "disallow")
UNRESERVED = r"[A-Za-z0-9._~-]"
BARE = r"[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]"


def spelled(x: Column) -> Column:
    """The one percent spelling of a path or rule: what no URL holds encoded (a stray % too), hex in capitals,
    unreserved decoded."""
    encoded = lambda c: F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
    plain = F.array_join(F.transform(F.split(x, ""), lambda c: F.when(c.rlike(f"^{BARE}?$"), c).otherwise(encoded(c))), "")

    def piece(p: Column, i: Column) -> Column:
        code = F.upper(F.substring(p, 1, 2))
        char = F.decode(F.unhex(code), "UTF-8")
        rest = F.substr(p, F.lit(3))
        decodes = code.rlike("^[2-7]") & char.rlike(f"^{UNRESERVED}$")
        return F.when(i == 0, p).when(~p.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.lit("%25"), p)).when(decodes, F.concat(char, rest)).otherwise(F.concat(F.lit("%"), code, rest))

    return F.array_join(F.transform(F.split(plain, "%", -1), piece), "")


def path(url: Column) -> Column:
    """Path and query of a URL as it is asked for, in the spelling of rules; / if there is no path."""
    rest = F.regexp_extract(urls.requested(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return spelled(F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))


def token(agent: Column) -> Column:
    """The product token of a user agent: the first word that ends in bot, wherever it stands; empty for a browser."""
    return F.regexp_extract(F.lower(F.coalesce(agent, F.lit(""))), r"([a-z0-9_-]*bot)\b", 1)


def named(line: Column) -> Column:
    """The token that a User-agent line names, or *."""
    return F.regexp_extract(F.lower(F.trim(line)), r"^([a-z0-9_-]+|\*)", 1)


def matches(key: Column, p: Column) -> Column:
    """Whether a rule (a prefix; * stands for anything, a last $ for the end) holds for a path: one pass, leftmost."""
    anchored = key.endswith("$")
    parts = F.split(F.regexp_replace(key, r"\$$", ""), r"\*")
    n, head, last = F.size(parts), F.element_at(parts, 1), F.element_at(parts, -1)
    between = F.slice(parts, F.lit(2), F.greatest(n - F.when(anchored, 2).otherwise(1), F.lit(0)))

    def step(at: Column, part: Column) -> Column:
        found = F.position(part, p, at + 1)
        return F.when((at < 0) | (part == ""), at).when(found == 0, F.lit(-1)).otherwise(found - 1 + F.length(part))

    at = F.aggregate(between, F.length(head), step)
    ends = F.when(n == 1, p == head).otherwise(p.endswith(last) & (F.length(p) - F.length(last) >= at))
    return p.startswith(head) & (at >= 0) & (~anchored | ends)


def lines(files: DataFrame) -> DataFrame:
    """base, line, key, value of the files (base, text): comments, byte-order marks and lines without a key go."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "^\ufeff", "")
    each = files.select("base", F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line", "raw")).withColumn("raw", F.split_part("raw", F.lit("#"), F.lit(1)))
    key = F.lower(F.trim(F.split_part("raw", F.lit(":"), F.lit(1))))
    return each.filter(F.col("raw").contains(":")).select("base", "line", key.alias("key"), F.trim(F.regexp_replace("raw", "^[^:]*:", "")).alias("value"))


def rules(files: DataFrame, agent: str) -> DataFrame:
    """base, rules (an array of allow, rule): those of all groups that name the agent, else those of the groups of *.

    User-agent lines in a row open one group; sites without a rule for the agent have no row."""
    order = Window.partitionBy("base").orderBy("line")  # a file's lines: bounded
    known = lines(files).filter(F.col("key").isin(*DIRECTIVES)).withColumn("names", F.col("key") == "user-agent")
    opens = F.col("names") & ~F.coalesce(F.lag("names").over(order), F.lit(False))
    grouped = known.withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(order))
    own = named(F.col("value"))
    groups = grouped.groupBy("base", "group").agg(
        F.coalesce(F.bool_or(F.col("names") & (own == agent.lower())), F.lit(False)).alias("own"),
        F.coalesce(F.bool_or(F.col("names") & (own == "*")), F.lit(False)).alias("any"),
        F.collect_list(F.when(~F.col("names") & (F.col("value") != ""), F.struct((F.col("key") == "allow").alias("allow"), spelled(F.col("value")).alias("rule")))).alias("rules"),
    )
    merged = groups.groupBy("base").agg(F.bool_or("own").alias("named"), F.flatten(F.collect_list(F.when(F.col("own"), F.col("rules")))).alias("mine"), F.flatten(F.collect_list(F.when(F.col("any"), F.col("rules")))).alias("all"))
    return merged.select("base", F.when(F.col("named"), F.col("mine")).otherwise(F.col("all")).alias("rules")).filter(F.size("rules") > 0)


def verdict(rules: Column, p: Column) -> Column:
    """allowed and the rule that decides: the longest that matches, Allow before Disallow; no rule allows."""
    held = F.filter(rules, lambda r: matches(r["rule"], p))
    best = F.array_max(F.transform(held, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["allow"].alias("allow"), r["rule"].alias("rule"))))
    return F.struct(F.coalesce(best["allow"], F.lit(True)).alias("allowed"), best["rule"].alias("rule"))


@F.arrow_udf(StringType())
def decoded(raw: pa.Array) -> pa.Array:
    """Text of a robots file: unpacked if gzipped, UTF-8, else cp1251, else UTF-8 with losses; null if it can't be
    unpacked (its rules are unknown then)."""

    def one(b: bytes | None) -> str | None:
        if b is None:
            return None
        if b[:2] == b"\x1f\x8b":
            try:
                b = zlib.decompressobj(31).decompress(b, 2 << 20)
            except zlib.error:
                return None
        for charset in ("utf-8", "cp1251"):
            try:
                return b.decode(charset)
            except UnicodeDecodeError:
                pass
        return b.decode("utf-8", "replace")

    return pa.array([one(x) for x in raw.to_pylist()], pa.string())


def answer(status: Column, body: Column, content_type: Column | None = None) -> Column:
    """state and why of an answer to /robots.txt: rules (2xx with a line of a known key), open (2xx without one, 4xx but
    429), else closed (429, 3xx, 5xx, none at all, a body that can't be unpacked: null)."""
    keys = "|".join(fixed.ROBOTS_KEYS)
    ruled = body.rlike(rf"(?im)^(?:{'|'.join(fixed.ROBOTS_MARKS)})?[ \t]*(?:{keys})[ \t]*:")
    bare = F.trim(F.regexp_replace(body, rf"^\s*(?:{'|'.join(fixed.ROBOTS_MARKS)})?", ""))
    page = bare.startswith("<") | F.contains(F.lower(F.coalesce(content_type if content_type is not None else F.lit(""), F.lit(""))), F.lit("html"))
    good = status.between(200, 299)
    state = F.when(good & body.isNull(), "closed").when(good & ruled, "rules").when(good, "open").when(status.between(400, 499) & (status != 429), "open").otherwise("closed")
    why = F.when(good & body.isNull(), "not unpacked").when(good & ruled, "file").when(good & (bare == ""), "empty").when(good & page, "a page").when(good, "no directive").when(
        status.between(300, 399), "redirect without a file").when(F.coalesce(status, F.lit(0)) == 0, "no answer").otherwise(F.concat(F.lit("HTTP "), status.cast("string")))
    return F.struct(state.alias("state"), why.alias("why"))


def state(status: Column, body: Column) -> Column:
    """What an answer means, a missing body being an empty one."""
    return answer(status, F.coalesce(body, F.lit("")))["state"]
