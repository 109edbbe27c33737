"""All queries of the library's own operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.functions import dates, fixed, html, robots, text, urls
from sitesieve.operators import relational as R
from sitesieve.plans import facts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "extractive_fact"
AS_OF = datetime.date(2024, 6, 15)

HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '^www\.', '')"
SPACE = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'), ' ')"


def query(sql: str | None = None):
    """Registers a function of (read,), where read(name) is a table."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def n(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


@query("select doc_id, lang, source, cast(length(text) as bigint) as chars from documents where lang = 'en' and n_chars >= 200")
def scan_project_filter(read):
    return read("documents").filter("lang = 'en' and n_chars >= 200").select("doc_id", "lang", "source", n(F.length("text")).alias("chars"))


@query(f"select host, page_id, url from (select *, {HOST} as host, row_number() over (partition by {HOST} order by page_id) rn from pages) where rn = 1")
def keep_first_per_site(read):
    return R.keep_first(read("pages").select("page_id", "url", urls.host(F.col("url")).alias("host")), ["host"], ["page_id"])


@query("""with u as (select 0 as ord, c_custkey as id, c_nationkey as nk, c_acctbal as bal from customer union all select 1, s_suppkey, s_nationkey, s_acctbal from supplier),
d as (select *, row_number() over (partition by nk, id order by ord) rn from u)
select ord, coalesce(case when bal < 0 then 'balance' when rn > 1 then 'duplicate' when nk in (3, 7) then 'excluded' end, 'kept') as drop_reason, cast(count(*) as bigint) as n from d group by all""")
def union_sources_dedup_drop_counts(read):
    c = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nk"), F.col("c_acctbal").alias("bal"))
    s = read("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nk"), F.col("s_acctbal").alias("bal"))
    u = R.union_prioritised([c, s], "ord").withColumn("rn", F.row_number().over(Window.partitionBy("nk", "id").orderBy("ord")))
    reason = R.first_failed([("balance", F.col("bal") < 0), ("duplicate", F.col("rn") > 1), ("excluded", F.col("nk").isin(3, 7))], F.lit("kept"))
    return u.groupBy("ord", reason.alias("drop_reason")).agg(F.count("*").alias("n"))


@query("""select s_suppkey, s_nationkey, case when row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) <= 2 then 'KEPT' else 'RESERVE' end as place from supplier""")
def priority_limit_reserve(read):
    return R.limited(read("supplier"), 2, [F.desc("s_acctbal"), "s_suppkey"], ["s_nationkey"]).select("s_suppkey", "s_nationkey", "place")


@query("""select o_orderkey, concat_ws(',', case when o_totalprice < 20000 then 'small' end, case when o_orderstatus = 'F' then 'closed' end, case when o_orderpriority like '1%' then 'urgent' end) as violations from orders""")
def collect_all_violations(read):
    checks = [("small", F.col("o_totalprice") < 20000), ("closed", F.col("o_orderstatus") == "F"), ("urgent", F.col("o_orderpriority").startswith("1"))]
    return read("orders").select("o_orderkey", F.array_join(R.all_failed(checks), ",").alias("violations"))


@query("select d.doc_id, d.lang from documents d where exists (select 1 from documents e where sha1(e.text) = sha1(d.text) and e.source <> d.source)")
def overlap_two_bases(read):
    d = read("documents").select("doc_id", "lang", "source", F.sha1(F.col("text").cast("binary")).alias("h"))
    several = d.groupBy("h").agg(F.min("source").alias("a"), F.max("source").alias("b")).filter("a <> b").select("h")
    return d.join(several, "h", "left_semi").select("doc_id", "lang")


@query("""select 'unused' as side, n_nationkey as k from nation where n_nationkey not in (select s_nationkey from supplier where s_acctbal > 6000)
union all select distinct 'undeclared', s_nationkey from supplier where s_acctbal > 6000 and s_nationkey not in (select n_nationkey from nation where n_regionkey < 4)""")
def except_both_ways(read):
    keys, used = read("nation").select(F.col("n_nationkey").alias("k"), "n_regionkey"), read("supplier").filter("s_acctbal > 6000").select(F.col("s_nationkey").alias("k"))
    unused, undeclared = keys.select("k").subtract(used), used.subtract(keys.filter("n_regionkey < 4").select("k"))
    return unused.select(F.lit("unused").alias("side"), "k").unionByName(undeclared.select(F.lit("undeclared").alias("side"), "k"))


@query("select d.doc_id, coalesce(nullif(case when l.quality = 1 then 'good' when l.quality = 0 then '' end, ''), d.source) as source from documents d left join labels l using (doc_id)")
def left_lookup_override(read):
    hand = read("labels").select("doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "").alias("source"))
    return R.overridden(read("documents").select("doc_id", "source"), hand, ["doc_id"], ["source"])


@query("select a.conv_id, a.turn, a.role, b.role as next_role from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1")
def positional_join(read):
    c = read("conversations")
    return c.select("conv_id", "turn", "role").join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next_role")), ["conv_id", "turn"])


@query("select r_name, c_mktsegment, cast(count(*) as bigint) as n, round(sum(c_acctbal), 2) as bal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all")
def dictionary_star_join(read):
    nations = F.broadcast(read("nation"))  # 25 and 5 rows by definition
    c = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))


@query("""with h as (select doc_id, sha1(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'), ' ')) as h from documents), g as (select h, count(*) c, min(doc_id) f from h group by h having count(*) > 1)
select doc_id, h, cast(c - 1 as bigint) as others, f as first_row from h join g using (h)""")
def self_join_duplicates(read):
    d = read("documents").select("doc_id", F.sha1(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")).cast("binary")).alias("h"))
    return R.group_sizes(d, "h", "doc_id")


@query("""with p as (select p_partkey as id, p_name as nm, p_brand as b from part) select x.id as row, y.id as peer from p x join p y on x.b = y.b and x.id < y.id and levenshtein(x.nm, y.nm) <= 2""")
def self_join_fuzzy_blocked(read):
    """Near names are found among the distinct ones of a brand; rows come back as pairs of bounded lists of their numbers."""
    p = read("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_brand")
    return R.near_rows(p, "id", "name", 2, ["p_brand"]).select("row", "peer")


@query("select c_custkey from customer where sha256(lower(trim(c_name, ' '))) not in (select sha256(lower(trim(c_name, ' '))) from customer where c_custkey % 10 = 0)")
def suppression_anti_join(read):
    c = read("customer")
    listed = c.filter("c_custkey % 10 = 0").select(F.sha2(F.lower(F.trim("c_name")), 256).alias("sha256"))
    return R.forgotten(c, F.col("c_name"), listed, [], "").select("c_custkey")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'O')")
def resume_anti_join(read):
    done = read("lineitem").filter("l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey"))
    return read("orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("""with s as (select user_id, min(ts) as lo, max(ts) as hi from events where event_type = 'click' group by user_id)
select e.event_id, e.user_id from events e join s on e.user_id = s.user_id and e.ts >= s.lo and e.ts <= s.hi where e.event_type <> 'click'""")
def containment_join(read):
    e = read("events")
    spans = e.filter("event_type = 'click'").groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return e.filter("event_type <> 'click'").join(spans, "user_id").filter("ts between lo and hi").select("event_id", "user_id")


@query("""select a.event_id as a_id, b.event_id as b_id from events a join events b on a.user_id = b.user_id and abs(epoch(a.ts) - epoch(b.ts)) <= 3600 where a.event_type = 'purchase' and b.event_type = 'view'""")
def band_join(read):
    e = read("events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    a = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("a_id"), F.col("s").alias("sa"))
    b = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("b_id"), F.col("s").alias("sb"))
    return R.band_join(a, b, ["user_id"], "sa", "sb", 3600).select("a_id", "b_id")


@query("""with p as (select *, sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as part from events),
q as (select event_id, event_type, last_value(case when event_type = 'click' then event_id end ignore nulls) over (partition by user_id, part order by ts, event_id rows between unbounded preceding and 1 preceding) as last_click from p)
select event_id, last_click from q where event_type = 'error' or event_type = 'purchase'""")
def asof_backward_barrier(read):
    e = R.last_before(read("events"), ["user_id"], ["ts", "event_id"], F.col("event_id"), F.col("event_type") == "click", F.col("event_type") == "signup", "last_click")
    return e.filter("event_type in ('error', 'purchase')").select("event_id", "last_click")


@query("""select event_id, last_value(case when event_type = 'view' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as view_before,
first_value(case when event_type = 'view' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between 1 following and unbounded following) as view_after from events""")
def asof_nearest_bidirectional(read):
    return R.nearest(read("events"), ["user_id"], ["ts", "event_id"], F.col("event_id"), F.col("event_type") == "view", "view_before", "view_after").select("event_id", "view_before", "view_after")


@query("""with a as (select l_orderkey, l_linenumber as a_line, row_number() over (partition by l_orderkey order by l_linenumber) k from lineitem where l_returnflag = 'N'),
b as (select l_orderkey, l_linenumber as b_line, row_number() over (partition by l_orderkey order by l_linenumber) k from lineitem where l_returnflag <> 'N')
select l_orderkey, cast(k as bigint) as k, a_line, b_line from a join b using (l_orderkey, k)""")
def zip_join_runs(read):
    x = read("lineitem")
    a, b = x.filter("l_returnflag = 'N'").select("l_orderkey", F.col("l_linenumber").alias("a_line")), x.filter("l_returnflag <> 'N'").select("l_orderkey", F.col("l_linenumber").alias("b_line"))
    return R.zipped(a, b, ["l_orderkey"], ["a_line"], ["b_line"]).select("l_orderkey", n("k").alias("k"), "a_line", "b_line")


@query("""select r_name, step, 'Dear ' || r_name || ', step ' || step as letter from region cross join (values ('1'), ('2'), ('3')) t(step)""")
def cross_join_templates(read):
    steps = F.explode(F.array(*[F.lit(x) for x in "123"])).alias("step")  # templates are a constant: no join is needed
    return read("region").select("r_name", steps).withColumn("letter", F.format_string("Dear %s, step %s", "r_name", "step"))


@query("""select event_type, user_mod, cast(count(*) as bigint) as n, round(sum(value), 2) as total, cast(count(case when value > 50 then 1 end) as bigint) as high
from (select *, cast(user_id % 5 as bigint) as user_mod from events) group by grouping sets ((event_type), (user_mod), ())""")
def tallies_grouping_sets(read):
    e = read("events").withColumn("user_mod", n(F.expr("user_id % 5")))
    return e.groupingSets([["event_type"], ["user_mod"], []], "event_type", "user_mod").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.count_if(F.col("value") > 50).alias("high"))


@query("""select l_suppkey, cast(count(distinct l_partkey) as bigint) as parts, round(count(case when l_returnflag = 'N' then 1 end) / count(*), 4) as share from lineitem group by l_suppkey
having count(*) >= 3 and count(case when l_returnflag = 'N' then 1 end) >= 0.35 * count(*)""")
def set_agg_having_share(read):
    g = read("lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("k"))
    return g.filter("n >= 3 and k >= 0.35 * n").select("l_suppkey", "parts", F.round(F.col("k") / F.col("n"), 4).alias("share"))


@query("select event_type, 'k' as name, cast(sum(cast(props->>'$.k' as bigint)) as bigint) as n from events group by event_type having sum(cast(props->>'$.k' as bigint)) is not null")
def merge_count_maps(read):
    counts = F.from_json("props", "map<string,bigint>").alias("counts")
    return R.merged_counts(read("events").select("event_type", counts), ["event_type"], "counts").filter("name = 'k'")


@query("""with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderdate desc, o_orderkey desc) rn from orders) select o_custkey, o_orderkey from r where rn = 1""")
def argmax_per_key(read):
    return R.argmax(read("orders"), ["o_custkey"], "o_orderkey", [F.col("o_totalprice"), F.col("o_orderdate"), F.col("o_orderkey")])


@query("""with r as (select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as bigint) as rank, cast(greatest(count(*) over (partition by o_custkey) - 3, 0) as bigint) as overflow from orders)
select * from r where rank <= 3""")
def topk_with_overflow(read):
    top, over = R.topk_with_overflow(read("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3)
    return top.join(over, "o_custkey").select("o_custkey", "o_orderkey", n("rank").alias("rank"), n("overflow").alias("overflow"))


@query("""with r as (select doc_id, lang, row_number() over (partition by lang order by n_chars desc, doc_id) rn from documents) select doc_id, lang, cast(rn as bigint) as rn from r where rn <= case lang when 'en' then 1 when 'de' then 6 else 3 end""")
def quota_topk(read):
    quota = F.when(F.col("lang") == "en", 1).when(F.col("lang") == "de", 6).otherwise(3)
    top, _ = R.topk_with_overflow(read("documents").select("doc_id", "lang", "n_chars"), ["lang"], [F.desc("n_chars"), "doc_id"], 6)
    return top.filter(F.col("rank") <= quota).select("doc_id", "lang", n("rank").alias("rn"))


@query("""select o_orderkey, cast(case substr(o_orderpriority, 1, 1) when '5' then 1 when '3' then 2 when '1' then 3 else 4 end as bigint) as place from orders""")
def custom_order_sort(read):
    order = F.array(*[F.lit(x) for x in "531"])
    place = F.array_position(order, F.substring("o_orderpriority", 1, 1))
    return read("orders").select("o_orderkey", n(F.when(place == 0, 4).otherwise(place)).alias("place")).orderBy("place", "o_orderkey")


@query("""select conv_id, turn, lag(role) over w as before, lead(role) over w as after from conversations window w as (partition by conv_id order by turn)""")
def neighbour_lines(read):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return read("conversations").select("conv_id", "turn", F.lag("role").over(w).alias("before"), F.lead("role").over(w).alias("after"))


@query("""select * from (select source, doc_id, cast(sum(n_chars) over (partition by source order by n_chars, doc_id rows unbounded preceding) as bigint) as running from documents) where running <= 10000""")
def budget_running_sum(read):
    return R.within_budget(read("documents"), ["source"], ["n_chars", "doc_id"], F.col("n_chars"), 10_000).select("source", "doc_id", "running")


@query("""with c as (select *, case when event_type is not distinct from lag(event_type) over (partition by user_id order by ts, event_id) and lag(event_id) over (partition by user_id order by ts, event_id) is not null then 0 else 1 end as c from events),
i as (select *, sum(c) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from c)
select user_id, cast(island as bigint) as island, event_type, cast(count(*) as bigint) as n, min(event_id) as first_id from i group by all""")
def gaps_islands(read):
    i = R.islands(read("events"), ["user_id"], ["ts", "event_id"], F.col("event_type"))
    return i.groupBy("user_id", "island", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("""with r as (select c_custkey, c_mktsegment, row_number() over (partition by c_mktsegment order by c_custkey) rn from customer) select c_custkey, c_mktsegment, cast(ceil(rn / 20.0) as bigint) as batch, cast((rn - 1) % 2 as bigint) as hand from r""")
def fixed_size_batches(read):
    return R.batches(read("customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], 20, ["c_mktsegment"])


@query("""with s as (select c_mktsegment, count(*) n from customer group by 1), o as (select *, sum(n % 2) over (order by c_mktsegment) odd from s),
r as (select c_custkey, c_mktsegment, row_number() over (partition by c_mktsegment order by sha256('42|' || cast(c_custkey as varchar)), cast(c_custkey as varchar)) rn from customer)
select c_custkey, c_mktsegment, case when rn <= n // 2 + case when n % 2 = 1 then odd % 2 else 0 end then 'A' else 'B' end as arm from r join o using (c_mktsegment)""")
def stratified_split(read):
    return R.split_ab(read("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", F.col("c_custkey").cast("string"), "42")


@query("""with x as (select 'c' || c_custkey as row_id, c_name as a, cast(c_nationkey as varchar) || ':' || cast(floor(c_acctbal / 1000) as bigint) as b from customer),
u as (select row_id, a as key from x union all select row_id, b from x)
select key, cast(count(distinct row_id) as bigint) as n_rows, min(row_id) as first_row from u where key is not null and key <> '' group by key having count(distinct row_id) > 1""")
def unpivot_uniqueness(read):
    x = read("customer").select(F.concat(F.lit("c"), "c_custkey").alias("row_id"), F.col("c_name").alias("a"), F.concat_ws(":", "c_nationkey", F.floor(F.col("c_acctbal") / 1000)).alias("b"))
    return R.repeated_keys(x, "row_id", ["a", "b"])


@query("select l_orderkey, l_linenumber from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')")
def fk_violations(read):
    return R.orphans(read("lineitem").select("l_orderkey", "l_linenumber"), read("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])


@query("""select o_orderpriority, cast(count(case when o_orderstatus = 'F' then 1 end) as bigint) as closed, cast(count(case when o_orderstatus = 'O' then 1 end) as bigint) as opened, abs(count(case when o_orderstatus = 'F' then 1 end) - count(case when o_orderstatus = 'O' then 1 end)) <= 1 as balanced from orders group by 1""")
def balance_assertions(read):
    g = read("orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O"]).count().na.fill(0)
    return g.select("o_orderpriority", F.col("F").alias("closed"), F.col("O").alias("opened"), (F.abs(F.col("F") - F.col("O")) <= 1).alias("balanced"))


@query("select user_id, cast(count(*) as bigint) as total, cast(count(case when event_type = 'error' then 1 end) as bigint) as failed, count(case when event_type = 'error' then 1 end) > count(*) * 0.25 as stop from events group by user_id")
def majority_gate(read):
    return R.silent_majority(read("events"), ["user_id"], F.col("event_type") == "error", 0.25)


@query("""select doc_id, case when n_chars < 200 then 'short' when lang <> 'en' then 'foreign' when text like '%###%' then 'noisy' else 'plain' end as kind,
cast(least(greatest(50 + case when n_chars > 2000 then 30 else 0 end + case when lang = 'en' then 25 else -10 end - case when text like '%$$$%' then 60 else 0 end, 0), 100) as bigint) as score from documents""")
def case_classification_score_clamp(read):
    kind = R.first_failed([("short", F.col("n_chars") < 200), ("foreign", F.col("lang") != "en"), ("noisy", F.contains("text", F.lit("###")))], F.lit("plain"))
    w = lambda c, a, b=0: F.when(c, a).otherwise(b)
    score = F.lit(50) + w(F.col("n_chars") > 2000, 30) + w(F.col("lang") == "en", 25, -10) - w(F.contains("text", F.lit("$$$")), 60)
    return read("documents").select("doc_id", kind.alias("kind"), n(F.least(F.greatest(score, F.lit(0)), F.lit(100))).alias("score"))


@query("select event_id from events where ts >= (select max(ts) from events) - to_days(case when event_type = 'error' then 1 else 7 end)")
def ttl_filter(read):
    e = read("events")
    now = e.agg(F.max("ts").alias("now"))  # one row
    return R.fresh(e.join(F.broadcast(now)), F.col("ts"), F.col("now"), F.when(F.col("event_type") == "error", 1).otherwise(7)).select("event_id")


@query("""with o as (select o_custkey, o_orderkey, o_totalprice from orders), new as (select o_custkey, max(o_orderkey) as o_orderkey, 0.0 as o_totalprice from orders where o_orderstatus = 'O' group by 1)
select * from o where o_custkey not in (select o_custkey from new) union all select o_custkey, o_orderkey, cast(o_totalprice as double) from new""")
def upsert_by_key(read):
    o = read("orders")
    new = o.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey")).withColumn("o_totalprice", F.lit(0.0))
    return R.upserted(o.select("o_custkey", "o_orderkey", "o_totalprice"), new, ["o_custkey"])


@query(f"select page_id, {HOST} as host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path, {HOST} || regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1), '/+$', '') as comparable from pages")
def host_path_comparable(read):
    u = F.col("url")
    return read("pages").select("page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.comparable(u).alias("comparable"))


@query(f"select page_id, array_to_string(string_split({HOST}, '.')[-2:], '.') as site, string_split({HOST}, '.')[-2] as core from pages")
def site_and_core(read):
    h = urls.host(F.col("url"))
    return read("pages").select("page_id", urls.site(h).alias("site"), urls.core(h).alias("core"))


@query(r"""select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])(?:ref|utm_[a-z]+|gclid)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '[?&]+$', '') as clean from pages""")
def url_no_tracking(read):
    return read("pages").select("page_id", urls.without_tracking(F.col("url")).alias("clean"))


@query(rf"""select page_id, {SPACE("replace(replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '&nbsp;', ' '), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&quot;', '" + chr(34) + "'), '&#39;', ''''), '&amp;', '&')")} as title,
cast(len(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1)) as bigint) as links, cast(len(regexp_extract_all(html, '(?is)<h1[^>]*>(.*?)</h1', 1)) as bigint) as h1s from pages""")
def html_title_links_h1(read):
    h = F.col("html")
    return read("pages").select("page_id", html.title(h).alias("title"), n(F.size(html.hrefs(h))).alias("links"), n(F.size(html.headings(h))).alias("h1s"))


def _unescaped_sql(x: str) -> str:
    for a, b in (("&nbsp;", "' '"), ("&copy;", "'©'"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{a}', {b})"
    return x


def _gone(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', {to}, 'g')"


LINES = f"list_filter(list_transform(string_split({_gone(_gone(_gone(_gone('html', html.HIDDEN, chr(39) + ' ' + chr(39)), chr(92) + 's+', chr(39) + ' ' + chr(39)), html.BLOCK, 'chr(10)'), html.ANY, chr(39) * 2)}, chr(10)), lambda s: {SPACE(_unescaped_sql('s'))}), lambda s: length(s) >= 2)"


@query(f"select page_id, {SPACE(_unescaped_sql(_gone(_gone('html', html.HIDDEN, chr(39) + ' ' + chr(39)), html.ANY, chr(39) + ' ' + chr(39))))} as visible from pages")
def html_visible_text(read):
    return read("pages").select("page_id", html.visible(F.col("html")).alias("visible"))


@query(f"""with l as (select distinct {HOST} as host, page_id, unnest({LINES}) as line from pages), m as (select host, count(distinct page_id) as members from l group by 1 having count(distinct page_id) >= 3)
select host, line, cast(members as bigint) as members from l join m using (host) group by host, line, members having count(distinct page_id) = members""")
def relational_division_lines(read):
    lines = read("pages").select(urls.host(F.col("url")).alias("host"), "page_id", F.explode(html.lines(F.col("html"))).alias("line"))
    return R.on_every(lines, "host", "page_id", "line", 3)


def _re2(pattern: str) -> str:
    """A pattern for the SQL: without the alternatives that need to look behind or ahead, which no fixture line meets."""
    return "(?i)" + pattern.replace("(?<![^\\W\\d_])", "").replace("'", "''")


FACT = rf"""with l as (select {HOST} as site, page_id, url, unnest(ls) as line, generate_subscripts(ls, 1) as i from (select *, list_distinct_ordered as ls from (select *, {LINES} as list_distinct_ordered from pages))),
f as (select site, page_id, url, line, min(i) as i from l group by all), n as (select *, row_number() over (partition by page_id order by i) - 1 as place from f),
m as (select site, count(distinct page_id) as members from f group by 1), common as (select site, line from f join m using (site) group by site, line, members having members >= 3 and count(distinct page_id) = members),
c as (select *, len(regexp_extract_all(line, '[^\s]+')) as words from n where (site, line) not in (select (site, line) from common) and length(line) between 50 and 700),
k as (select *, case when regexp_matches(url, '^[^:]+://[^/]+/?$') then 'home' else 'other' end as kind from c where words >= 7 and len(regexp_extract_all(line, '\pL')) >= 0.6 * length(line) and len(regexp_extract_all(line, ',')) <= 0.35 * words and not regexp_matches(line, '{_re2(fixed.BOILERPLATE)}')),
s as (select *, 3 * regexp_matches(line, '{_re2(fixed.FACT_HINT)}')::int + (len(regexp_extract_all(line, '[a-zA-Z]')) > 0.5 * len(regexp_extract_all(line, '\pL')))::int
  - 3 * (regexp_matches(line, '{_re2(fixed.GENERIC_FACT)}') or regexp_matches(line, '{_re2(fixed.TRIVIAL_NEWS)}') or regexp_matches(line, '{_re2(fixed.OPENING_HOURS)}'))::int - 2 * (kind = 'home' and place < 4)::int as score from k),
r as (select *, row_number() over (partition by site order by score desc, page_id, place) rn from s)
select site, page_id, cast(score as bigint) as score, line as fact from r where rn = 1"""


@query(FACT.replace("list_distinct_ordered as ls", "list_distinct_ordered as ls"))
def extractive_fact(read):
    """The best line of each site: lines of all its pages go, the others are scored, and the first of the best wins. The
    fixture has no dated lines, so the SQL leaves the terms of dates out."""
    kind = F.when(F.col("url").rlike("^[^:]+://[^/]+/?$"), "home").otherwise("other")
    pages = read("pages").select(urls.host(F.col("url")).alias("site"), "page_id", "url", kind.alias("kind"), F.posexplode(html.lines(F.col("html"))).alias("place", "line"))
    common = R.on_every(pages, "site", "page_id", "line", 3).select("site", "line")
    lines = pages.join(common, ["site", "line"], "left_anti").withColumn("page_order", F.col("page_id"))
    best = facts.scored_lines(lines, AS_OF).withColumn("rn", F.row_number().over(Window.partitionBy("site").orderBy(F.desc("score"), "page_order", "place"))).filter("rn = 1")
    return best.select("site", "page_id", n("score").alias("score"), F.col("line").alias("fact"))


NUMBERS = "regexp_extract_all(regexp_replace(regexp_replace({x}, '[\\s.,](\\d{{3}})\\b', chr(1) || '\\1', 'g'), '(\\d)' || chr(1), '\\1', 'g'), '\\d+')"


@query(rf"""with m as (select doc_id, text, regexp_replace(text, '([.!?…]+)(\s+[A-ZА-ЯЁ«"(])', '\1' || chr(1) || '\2', 'g') as marked from documents),
t as (select doc_id, text, list_filter(list_transform(regexp_extract_all(marked, '[^\s' || chr(1) || ']*?[.!?…]+(?:' || chr(1) || '|\s*$)'), lambda x: regexp_extract(x, '^([^\s' || chr(1) || ']*?)([.!?…]+)[\s' || chr(1) || ']*$', ['word', 'stop'])),
  lambda s: not (s.stop like '.%' and length(s.word) <= 3 and regexp_matches(s.word, '^\P{{Lu}}*\p{{Ll}}\P{{Lu}}*$'))) as ends from m)
select doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g'), ' ') as norm, cast(len(list_distinct({NUMBERS.format(x="text")})) as bigint) as numbers, cast(greatest(len(ends), 1) as bigint) as sentences from t""")
def text_measures(read):
    t = F.col("text")
    return read("documents").select("doc_id", F.trim(F.regexp_replace(F.lower(t), r"\s+", " ")).alias("norm"), n(F.size(text.digit_runs(t))).alias("numbers"), n(text.sentences(t)).alias("sentences"))


@query(r"""select doc_id, unnest(list_distinct(regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})', 1))) as email from documents""")
def email_extract(read):
    return read("documents").select("doc_id", F.explode(text.emails(F.col("text"))).alias("email"))


@query("""select c_custkey, 'call 8 (***) ***-**-' || lpad(cast(c_custkey % 100 as varchar), 2, '0') || ', fax +7 495 1234567' as masked from customer""")
def mask_mobile_numbers(read):
    k = F.col("c_custkey")
    line = F.concat(F.lit("call 8 (916) "), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-12-"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit(", fax +7 495 1234567"))
    return read("customer").select("c_custkey", text.masked_mobiles(line).alias("masked"))


@query(r"""with p as (select distinct p_name as l, split_part(p_name, ' ', 2) as w from part) select a.l as a, b.l as b from p a join p b on a.w = b.w
where a.l <> b.l and regexp_replace(a.l, '\D', '', 'g') = regexp_replace(b.l, '\D', '', 'g') and levenshtein(a.l, b.l) <= case when least(length(a.l), length(b.l)) < 6 then 1 else 2 end""")
def levenshtein_typo(read):
    p = read("part").select("p_name", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"))
    near = R.near_strings(p, "p_name", 2, ["w"])
    both = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.filter(text.is_typo(F.col("a"), F.col("b")))


@query("""select o_orderkey, cast((2024 - year(o_orderdate)) * 12 + 6 - month(o_orderdate) - case when 15 < day(o_orderdate) then 1 else 0 end as bigint) as months, date_diff('day', cast(o_orderdate as date), date '2024-06-15') > 365 as stale from orders""")
def months_and_staleness(read):
    now, day = F.lit("2024-06-15").cast("date"), F.to_date("o_orderdate")
    return read("orders").select("o_orderkey", n(dates.whole_months(day, now)).alias("months"), dates.is_stale(day, now).alias("stale"))


@query("""select event_id, case when props is null or props = '' then 'EMPTY' when try_cast(props->>'$.k' as bigint) is null then 'NO_KEY' when cast(props->>'$.k' as bigint) > 50 then 'HIGH' else 'OK' end as verdict from events""")
def json_answer_validate(read):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return read("events").select("event_id", R.first_failed([("EMPTY", F.col("props").isNull() | (F.col("props") == "")), ("NO_KEY", k.isNull()), ("HIGH", k > 50)], F.lit("OK")).alias("verdict"))


@query("""with g as (select o_orderstatus as s, count(*) as c from orders group by 1) select 'all' as step, cast(count(*) as bigint) as n from orders union all select 'open', cast(count(*) as bigint) from orders where o_orderstatus = 'O'
union all select 'large', cast(count(*) as bigint) from orders where o_orderstatus = 'O' and o_totalprice > 100000 union all select 'one_each', cast(count(distinct o_custkey) as bigint) from orders where o_orderstatus = 'O' and o_totalprice > 100000""")
def funnel_report(read):
    opened, large = F.col("o_orderstatus") == "O", F.col("o_totalprice") > 100000
    one = read("orders").agg(F.count("*").alias("all"), F.count_if(opened).alias("open"), F.count_if(opened & large).alias("large"), F.count_distinct(F.when(opened & large, F.col("o_custkey"))).alias("one_each"))
    return one.unpivot([], ["all", "open", "large", "one_each"], "step", "n")


ROBOTS = "User-agent: *\nDisallow: /\n\nUser-agent: SieveBot/1.0\nUser-agent: other\nDisallow: /fr/ # French\nAllow: /fr/2\n\nUser-agent: sievebot\nDisallow: /*/7*$\n"


@query(f"""with p as (select page_id, {HOST} as host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1) as rest from pages), q as (select page_id, host, case when rest like '/%' then rest else '/' || rest end as p from p)
select page_id, case when host like 'm.%' then true when p like '/%/7%' then false when p like '/fr/2%' then true when p like '/fr/%' then false else true end as allowed,
case when host like 'm.%' then null when p like '/%/7%' then '/*/7*$' when p like '/fr/2%' then '/fr/2' when p like '/fr/%' then '/fr/' end as rule from q""")
def robots_verdicts(read):
    pages = read("pages").select("page_id", urls.host(F.col("url")).alias("base"), robots.path(F.col("url")).alias("p"))
    files = pages.select("base").distinct().filter(~F.col("base").startswith("m.")).withColumn("text", F.lit(ROBOTS))
    judged = pages.join(robots.rules(files, "sievebot"), "base", "left").withColumn("v", robots.verdict(F.col("rules"), F.col("p")))
    return judged.select("page_id", "v.allowed", "v.rule")


@query("""select event_id, case when user_id % 7 = 0 then 'closed' when user_id % 7 = 1 then 'open' when user_id % 7 = 2 then 'rules' when user_id % 7 = 3 then 'open' else 'closed' end as state from events""")
def robots_states(read):
    k = F.col("user_id") % 7
    status = F.when(k == 0, 503).when(k == 1, 404).when(k.isin(2, 3), 200).when(k == 4, 429).when(k == 5, 301)
    return read("events").select("event_id", robots.state(status, F.when(k == 2, F.lit(ROBOTS)).otherwise(F.lit("<html>"))).alias("state"))


from sitesieve import catalogue_more  # noqa: E402, F401  registers the queries over pages, people, checks and files
