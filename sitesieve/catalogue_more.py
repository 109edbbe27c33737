"""Queries of pages, people, checks, facts, discovery, files, campaigns and streams, with their SQL where SQL has one.

The fixtures hold no companies: sites are hosts of pages, rows to check are made from pages and customers, letters from
customers. Queries without SQL work on whole tables or on small pages written here; tests compare these with what a reader
sees.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitesieve.catalogue import AS_OF, HOST, LINES, NUMBERS, _re2, n, query
from sitesieve.functions import dates, fixed, fuzzy, html, markup, people, text, urls
from sitesieve.operators import relational as R
from sitesieve.plans import campaign, checks, discovery, facts, pages, pairing, verdicts
from sitesieve.sources import tables
from sitesieve.streaming import pages as streams

HOSTED = lambda: urls.host(F.col("url"))


# --- pages and links


@query()
def html_page_records(read):
    p = pages.parsed(read("pages"))
    return p.select("page_id", "page.title", n(F.size("page.lines")).alias("lines"), n(F.size("page.links")).alias("links"), n(F.size("page.h1")).alias("h1s"))


@query()
def html_atoms(read):
    return pages.atom_rows(read("pages")).select("page_id", n("number").alias("atom"), "text", n(F.size("path")).alias("depth"), "chrome", n("heading").alias("heading"), "section")


@query()
def html_elements(read):
    return pages.element_spans(pages.atom_rows(read("pages"))).select("page_id", n("element").alias("element"), n("lo").alias("lo"), n("hi").alias("hi"))


@query()
def site_links_exploded(read):
    return pages.site_links(pages.parsed(read("pages"))).select("page_id", n("place").alias("place"), "link", "path", "label")


@query()
def html_visible_length(read):
    return read("pages").select("page_id", n(markup.visible_length("html")).alias("length"))


PATHS = ["/contacts/", "/company/staff/", "/about-us", "/about/history/", "/press/2024/x", "/catalog/list.pdf", "/otdel-prodazh/plan", "/team/ivanov", "/x", "/news/"]
LABELS = ["Contacts", "", "About us", "Team", "press"]


def _kinds_sql() -> str:
    q = lambda x: "'" + _re2(x) + "'"
    one = []
    for k, w, p, t in fixed.PAGE_KINDS:
        by_path, by_text = f"regexp_matches(path, {q(p)})", f"regexp_matches(label, {q(t)})"
        deeper = f"({by_path} and not {by_text} and trim(regexp_replace(path, '(?i)^.*?{p}', ''), '/') <> '')"
        fits = f"({by_path} or {by_text})" + (f" and not {deeper}" if k in ("about", "press") else "")
        one.append(f"case when {fits} then {{'score': {w} + case when {by_path} and {by_text} then 1 when {deeper} then -3 else 0 end, 'o': {-w}, 'kind': '{k}'}} end")
    return ", ".join(one)


@query(f"""with p as (select event_id, ({PATHS})[cast(event_id % 10 as integer) + 1] as path, ({LABELS})[cast(event_id // 10 % 5 as integer) + 1] as label from events),
k as (select event_id, list_sort(list_filter([{_kinds_sql()}], lambda x: x is not null), 'desc')[1] as best, path from p)
select event_id, best.kind as kind, cast(best.score as bigint) as score from k where best is not null and not regexp_matches(path, '{_re2(fixed.SKIPPED_FILES)}')""")
def link_classification_best(read):
    at = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(i, F.lit(len(xs))) + 1).cast("int"))
    e = read("events").select("event_id", at(PATHS, F.col("event_id")).alias("path"), at(LABELS, F.floor(F.col("event_id") / 10)).alias("label"))
    return e.withColumn("k", pages.page_kind(F.col("path"), F.col("label"))).filter("k is not null").select("event_id", "k.kind", n("k.score").alias("score"))


HOME = [
    ("Новости", "/novosti/"), ("О компании", "/company/"), ("Blog", "/x/blog/"), ("Кейсы", "/cases/"), ("About our CNC machines", "/cases-about-sheet-metal-forming-machine/"), ("", "/about/"), ("Контакты", "/contacts/"),
    ("Контакты клиентов в CRM", "/crm/"), ("Catalog", "/files/a.pdf"), ("Пресс-релизы 2024", "/p"),
]


def _homes(read):
    """A homepage for each customer below 40, its links rotated."""
    links = "".join(f'<a href="{h}">{t}</a> ' for t, h in HOME)
    return read("customer").filter("c_custkey < 40").select(F.col("c_custkey").alias("page_id"), F.concat(F.lit("https://www.site"), "c_custkey", F.lit(".example/")).alias("url"), F.lit(f"<body>{links}</body>").alias("html"))


@query("""select c_custkey as page_id, 'https://www.site' || c_custkey || '.example' || path as link, kind, cast(score as bigint) as score, cast(rank as bigint) as rank from customer cross join
(values ('/novosti/', 'news', 3, 1), ('/company/', 'about', 3, 2), ('/cases-about-sheet-metal-forming-machine/', 'about', 3, 3), ('/p', 'news', 3, 4), ('/x/blog/', 'news', 3, 5), ('/cases/', 'news', 2, 6), ('/about/', 'about', 2, 7)) t(path, kind, score, rank) where c_custkey < 40""")
def ranked_homepage_links(read):
    ranked = pages.ranked_links(pages.site_links(pages.parsed(_homes(read))))
    return ranked.select("page_id", "link", "kind", "score", n("rank").alias("rank"))


@query("""select c_custkey as page_id, 'https://www.site' || c_custkey || '.example/contacts/' as link from customer where c_custkey < 40""")
def contacts_page(read):
    return pages.contacts_link(pages.site_links(pages.parsed(_homes(read))))


@query("""select c_custkey as page_id, 'https://www.site' || c_custkey || '.example' || path as link from customer cross join (values ('/company/'), ('/novosti/'), ('/p')) t(path) where c_custkey < 40""")
def quota_subpages(read):
    links = pages.ranked_links(pages.site_links(pages.parsed(_homes(read)))).filter("link not like '%/blog/%'")
    return pages.picked_links(links, 3).select("page_id", "link")


@query(f"""with l as (select {HOST} as site, page_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from (select *, {LINES} as ls from pages)), f as (select site, page_id, line, min(i) as i from l group by all),
o as (select *, row_number() over (partition by page_id order by i) - 1 as place from f), m as (select site, count(distinct page_id) as members from f group by 1),
common as (select site, line from f join m using (site) group by site, line, members having members >= 3 and count(distinct page_id) = members), k as (select *, (site, line) not in (select (site, line) from common) as keep from o),
w as (select *, max(case when keep then place end) over (partition by page_id order by place rows between unbounded preceding and 1 preceding) as before, lead(keep) over (partition by page_id order by place) as after from k)
select site, page_id, cast(place as bigint) as place, case when keep then line else '[…]' end as line from w where keep or (before is not null and after)""")
def boilerplate_lines(read):
    lines = read("pages").select(HOSTED().alias("site"), "page_id", F.posexplode(html.lines(F.col("html"))).alias("place", "line"))
    return pages.content_lines(lines, AS_OF).select("site", "page_id", n("place").alias("place"), "line")


@query("""with r as (select o_custkey, o_orderkey, o_orderpriority as u, o_orderstatus as d from orders where o_custkey < 200), x as (select o_custkey as site, min(o_orderkey) as o_orderkey from r group by 1) select * from x""")
def first_of_distinct_pages(read):
    """The first page that a site's fold over URLs and text hashes keeps."""
    r = read("orders").filter("o_custkey < 200").select(F.col("o_custkey").alias("site"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    return pages.distinct_pages(r, "site", "o_orderkey", "o_orderpriority", "o_orderstatus").groupBy("site").agg(F.min("o_orderkey").alias("o_orderkey"))


@query()
def distinct_pages_by_url_or_text(read):
    r = read("orders").select(F.col("o_custkey").alias("site"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    return pages.distinct_pages(r, "site", "o_orderkey", "o_orderpriority", "o_orderstatus").select("site", "o_orderkey")


@query("""with recursive links as (select n_regionkey as site, n_nationkey as t from nation), r as (select site, t, row_number() over (partition by site order by (t * 7) % 11 desc, t desc) as k from links)
select site, cast(coalesce(case when k = 0 then null else t end, -1) as integer) as page, cast(k as integer) as step from (select site, t, k from r where k <= 3 union all select distinct site, -1, 0 from links)""")
def best_first_traversal(read):
    """A start page links all pages of its site; the budget is four."""
    nation = read("nation")
    links = nation.select(F.col("n_regionkey").alias("site"), F.lit(-1).alias("source"), F.col("n_nationkey").alias("target"), ((F.col("n_nationkey") * 7) % 11).alias("score"))
    return pages.traversed(links, nation.select(F.col("n_regionkey").alias("site"), F.lit(-1).alias("page")).distinct(), 4)


@query("""with e as (select *, (epoch(ts) / 3600)::bigint as h from events), s as (select user_id, min(h) as lo, min(h) + 40 as hi from e where event_type = 'click' group by 1 union all select user_id, max(h) - 30, max(h) from e where event_type = 'view' group by 1)
select e.event_id, s.lo, s.hi from e join s on e.user_id = s.user_id and e.h between s.lo and s.hi""")
def interval_containment(read):
    e = read("events").withColumn("h", F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("bigint"))
    span = lambda kind, lo, hi: e.filter(F.col("event_type") == kind).groupBy("user_id").agg(lo.alias("lo"), hi.alias("hi"))
    spans = span("click", F.min("h"), F.min("h") + 40).unionByName(span("view", F.max("h") - 30, F.max("h")))
    return pages.inside(e, spans, ["user_id"], "h").select("event_id", "lo", "hi")


@query("""with x as (select event_id, user_id, ts, case when event_type in ('view', 'signup') then event_type end as t from events),
w as (select event_id, last_value(case when t is not null then event_id end ignore nulls) over p as b, first_value(case when t is not null then event_id end ignore nulls) over f as a from x
  window p as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), f as (partition by user_id order by ts, event_id rows between 1 following and unbounded following))
select w.event_id, case when eb.event_type = 'view' then b end as view_before, case when ea.event_type = 'view' then a end as view_after from w left join events eb on eb.event_id = b left join events ea on ea.event_id = a""")
def asof_nearest_barrier(read):
    return R.nearest(read("events"), ["user_id"], ["ts", "event_id"], F.col("event_id"), F.col("event_type") == "view", "view_before", "view_after", F.col("event_type") == "signup").select("event_id", "view_before", "view_after")


# --- strings


def _squash_sql(x: str) -> str:
    x = f"regexp_replace(lower({x}), '[^a-z0-9]', '', 'g')"
    for a, b in fixed.SQUASH:
        x = f"replace({x}, '{a}', '{b}')"
    x = f"replace(replace(replace({x}, 'ch', chr(1)), 'c', 'k'), chr(1), 'ch')"
    return f"(select array_to_string(list_transform(list_filter(list_zip(v, list_prepend(null, v)), lambda z: z[2] is null or z[1] <> z[2]), lambda z: z[1]), '') from (select string_split({x}, '') as v))"


@query(f"select p_partkey, {_squash_sql('p_name')} as key from part where p_partkey % 3 >= 0")
def squash_key(read):
    return read("part").select("p_partkey", text.squashed(F.col("p_name")).alias("key"))


@query(r"""select doc_id, round(coalesce(len(regexp_extract_all(text, '[а-яА-ЯёЁ]')) / nullif(len(regexp_extract_all(text, '\pL')), 0), 0), 6) as cyrillic, round(coalesce(len(regexp_extract_all(text, '[a-zA-Z]')) / nullif(len(regexp_extract_all(text, '\pL')), 0), 0), 6) as latin from documents""")
def cyr_lat_ratio(read):
    t = F.col("text")
    return read("documents").select("doc_id", F.round(text.cyrillic_share(t), 6).alias("cyrillic"), F.round(text.latin_share(t), 6).alias("latin"))


@query(rf"""with p as (select a.doc_id, list_distinct({NUMBERS.format(x="a.text")}) as x, list_distinct({NUMBERS.format(x="b.text")}) as y from documents a join documents b on b.doc_id = a.doc_id + 1)
select doc_id, array_to_string(list_sort(list_filter(x, lambda v: length(v) >= 2 and not list_contains(y, v))), ',') as missing from p""")
def numbers_missing(read):
    d = read("documents")
    pair = d.select("doc_id", "text").join(d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next")), "doc_id")
    return pair.select("doc_id", F.array_join(text.numbers_missing(F.col("text"), F.col("next")), ",").alias("missing"))


@query()
def ratio_match(read):
    names = read("part").select(F.col("p_name").alias("a")).distinct().withColumn("w", F.split_part("a", F.lit(" "), F.lit(2)))
    pairs = names.join(names.select(F.col("a").alias("b"), "w"), "w").filter("a < b")
    return pairs.select("a", "b", F.round(fuzzy.ratio("a", "b"), 6).alias("ratio")).filter("ratio >= 0.8")


@query("""select s_suppkey, s_name, upper(substr(w, 1, 1)) || lower(substr(w, 2)) as shown, len(list_filter(string_split(lower(s_name), '#'), lambda x: length(x) >= 2)) >= 1 as named from (select *, upper(split_part(s_name, '#', 1)) as w from supplier)""")
def capitals_and_name_words(read):
    w = F.upper(F.split_part("s_name", F.lit("#"), F.lit(1)))
    return read("supplier").select("s_suppkey", "s_name", text.capitalised(w).alias("shown"), (F.size(text.name_words(F.col("s_name"))) >= 1).alias("named"))


@query("""select c_custkey, sha256('person:' || lower(trim(c_name, ' ')) || '|' || lower(substr(c_mktsegment, 1, 1)) || '@site.example') as h, 'one ' || c_custkey || '. two. ' as first_two from customer""")
def person_hashes(read):
    line = F.concat(F.lit("one "), F.col("c_custkey"), F.lit(". two.  Three."))
    return read("customer").select("c_custkey", text.person_hash(F.col("c_name"), F.col("c_mktsegment"), F.lit("site.example")).alias("h"), F.concat(text.first_sentences(line), F.lit(" ")).alias("first_two"))


# --- hosts

HOSTS = ["shop.site.com.cn", "zavod.nnov.ru", "www.a.b.example", "acme.tilda.ws", "vk.com", "mail.ru", "x.net.de", "sub.dzen.ru"]
HOST_SQL = "({})[cast(c_custkey % 8 as integer) + 1]".format(HOSTS)
HOST_ANSWERS = [("site.com.cn", "site.com.cn", False, False), ("nnov.ru", "zavod.nnov.ru", False, False), ("b.example", "b.example", False, False), ("tilda.ws", "acme.tilda.ws", False, False),
                ("vk.com", "vk.com", True, False), ("mail.ru", "mail.ru", True, True), ("net.de", "net.de", False, False), ("dzen.ru", "dzen.ru", True, False)]


def _hosts_sql() -> str:
    """Last two labels, or three under a suffix, by lists: no constant answers."""
    labels = "list_filter(string_split(regexp_replace(h, '^www\\.', ''), '.'), lambda x: x <> '')"
    last = lambda k: f"array_to_string(list_slice(l, greatest(len(l) - {k - 1}, 1), len(l)), '.')"
    under = lambda k, values: f"(len(l) > {k} and list_contains({list(values)}, {last(k)}))"
    return f"""with h as (select c_custkey, {HOST_SQL} as h from customer), l as (select c_custkey, regexp_replace(h, '^www\\.', '') as h, {labels} as l from h),
r as (select c_custkey, h, case when len(l) >= 3 and list_contains({fixed.TWO_PART_SUFFIXES}, {last(2)}) then {last(3)} else {last(2)} end as registrable,
  case when {under(3, fixed.SHARED_SUFFIXES)} then {last(4)} when {under(2, fixed.SHARED_SUFFIXES)} then {last(3)} else {last(2)} end as own_site from l)
select c_custkey, registrable, own_site, list_contains({fixed.AGGREGATORS}, h) or list_contains({fixed.AGGREGATORS}, own_site) or list_contains({fixed.AGGREGATORS}, registrable) as aggregator,
  list_contains({fixed.FREE_MAIL}, h) or list_contains({fixed.FREE_MAIL}, registrable) as free_mail from r"""


@query(_hosts_sql())
def site_units(read):
    h = urls.host(F.concat(F.lit("https://"), F.element_at(F.array(*map(F.lit, HOSTS)), (F.col("c_custkey") % 8 + 1).cast("int")), F.lit("/x")))
    return read("customer").select("c_custkey", urls.registrable(h).alias("registrable"), urls.own_site(h).alias("own_site"), urls.is_aggregator(h).alias("aggregator"), urls.is_free_mail(h).alias("free_mail"))


@query("""select page_id, regexp_replace(url, '^([^:]+://[^/]+).*$', '\\1') || '/c' as clean from pages""")
def url_dot_segments(read):
    base = F.regexp_extract("url", "^[^:]+://[^/]+", 0)
    return read("pages").select("page_id", urls.requested(F.concat(base, F.lit("/a/./b/%2E%2e/../c#part"))).alias("clean"))


@query("""select s_suppkey, 'xn--e1afmkfd.xn--p1ai' as ascii, 'пример' as core from supplier""")
def idn_hosts(read):
    h = F.when(F.col("s_suppkey") >= 0, F.lit("Пример.рф."))
    return read("supplier").select("s_suppkey", urls.ascii_host(h).alias("ascii"), urls.own_core(h).alias("core"))


# --- dates


@query("""select o_orderkey, cast(o_orderdate as date) as day, case when o_orderkey % 3 < 2 then cast(o_orderdate as date) end as entry from orders""")
def date_extract(read):
    day = lambda f: F.date_format("o_orderdate", f)
    month = F.element_at(F.array(*map(F.lit, ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"])), F.month("o_orderdate"))
    english = F.concat(month, F.lit(" "), F.dayofmonth("o_orderdate"), F.lit(", "), F.year("o_orderdate"))
    k = F.col("o_orderkey") % 3
    line = F.when(k == 0, F.concat(day("dd.MM.yyyy"), F.lit(" A release with a very long name that goes on and on and on"))).when(k == 1, F.concat(F.lit("Read more "), day("yyyy-MM-dd"))).otherwise(F.concat(F.lit("A report on the equipment of all the plants, written on "), english, F.lit(", is here")))
    x = read("orders").select("o_orderkey", line.alias("line")).withColumn("s", dates.spans(F.col("line"), AS_OF))
    return x.select("o_orderkey", F.try_element_at(dates.days(F.col("s")), F.lit(1)).alias("day"), dates.entry_day(F.col("line"), F.col("s")).alias("entry"))


@query("""with o as (select o_custkey as site, o_orderkey as place, cast(o_orderdate as date) as day from orders where cast(o_orderdate as date) > date '1998-07-01' - 366 and cast(o_orderdate as date) <= date '1998-07-01' + 7)
select site, max(day) as day from o group by 1""")
def freshest_item(read):
    as_of = datetime.date(1998, 7, 1)
    lines = read("orders").select(F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("place"), F.concat(F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(" An order of goods for the house of the customer and more")).alias("line"))
    return facts.freshest(facts.dated_entries(lines, as_of, ["site"]), as_of).select("site", "day")


# --- people

BOX = ["info", "sales-msk", "ivanov.p", "kom.dir", "gd", "acme", "director.g", "b2b_sales", "117", "maria"]


@query(f"""with b as (select c_custkey, ({BOX})[cast(c_custkey % 10 as integer) + 1] as l from customer), p as (select *, list_filter(regexp_split_to_array(l, '[._+-]+'), lambda x: x <> '') as parts, regexp_replace(l, '[._-]+', '', 'g') as bare from b),
r as (select *, regexp_matches(bare, '(?i)^(?:to|ask)?(?:{fixed.ROLE_WORDS})[0-9._-]*$') as post, list_transform(parts, lambda x: regexp_matches(x, '(?i)^(?:to|ask)?(?:{fixed.ROLE_WORDS})[0-9]*$')) as roles from p)
select c_custkey, l as local, regexp_matches(l, '(?i)^(?:{fixed.GENERIC_WORDS})[0-9._-]*$') or regexp_replace(l, '[0-9._-]', '', 'g') = 'acme' or (not post and len(list_filter(parts, lambda x: regexp_matches(x, '(?i)^[0-9]*(?:{fixed.GENERIC_WORDS})[0-9]*$'))) > 0) as generic,
post or (len(list_filter(roles, lambda x: x)) > 0 and len(list_filter(list_zip(parts, roles), lambda z: not (z[2] or length(z[1]) = 1 or regexp_matches(z[1], '^[0-9]+$')))) = 0) as post from r""")
def email_type(read):
    local = F.element_at(F.array(*map(F.lit, BOX)), (F.col("c_custkey") % 10 + 1).cast("int"))
    return read("customer").select("c_custkey", local.alias("local"), people.is_generic_box(local, F.lit("ac-me")).alias("generic"), people.is_post_box(local).alias("post"))


TITLES = ["Коммерческий директор", "Менеджер по продажам", "Начальник отдела продаж", "Генеральный директор", "Директор по маркетингу", "Технический директор", "Региональный директор", "Директор по развитию", "Руководитель отдела логистики", "Помощник директора"]


@query()
def title_roles(read):
    t = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("c_custkey") % 10 + 1).cast("int"))
    return read("customer").select("c_custkey", t.alias("title"), people.role(t).alias("r")).select("c_custkey", "title", "r.role", "r.deputy")


@query()
def email_spans(read):
    return read("documents").select("doc_id", F.explode(people.email_spans(F.col("text"))).alias("s")).select("doc_id", n("s.start").alias("start"), n("s.stop").alias("stop"), F.col("s.text").alias("email"))


@query()
def name_and_title_spans(read):
    line = F.concat(F.lit("Директор Иванов Пётр Ильич ("), F.col("c_custkey"), F.lit("), Ольга Смирнова, коммерческий директор: тел. 1"))
    x = R.spread(read("customer").select("c_custkey")).select("c_custkey", people.name_spans(line).alias("names"), people.title_spans(line).alias("titles"))
    return x.select("c_custkey", F.array_join(F.transform("names", lambda s: s["text"]), ",").alias("names"), F.array_join(F.transform("titles", lambda s: s["text"]), ",").alias("titles"))


CARDS = """<html><head><title>Завод</title></head><body><header>info@acme{0}.example</header><main><h2>Команда</h2>
<div class="card"><p>Иванов Пётр Ильич</p><p>Коммерческий директор</p><p>ivanov@acme{0}.example</p></div>
<div class="card"><p>Смирнова Ольга</p><p>Менеджер по продажам</p><p>smirnova@acme{0}.example</p></div>
<div class="card"><p>Отдел сбыта</p><p>sbyt@acme{0}.example, +7 495 123-45-67</p></div></main><footer>© 2024 ACME</footer></body></html>"""


def _teams(read):
    html_ = F.regexp_replace(F.lit(CARDS), r"\{0\}", F.col("s_suppkey").cast("string"))
    return read("supplier").select(F.col("s_suppkey").alias("page_id"), F.concat(F.lit("https://acme"), "s_suppkey", F.lit(".example/team/")).alias("url"), html_.alias("html"), F.lit("team").alias("kind"))


@query("""select s_suppkey as page_id, who || '@acme' || s_suppkey || '.example' as email, key as person_key, title, method, reason from supplier cross join (values ('info', null, null, null, 'GENERIC'),
('ivanov', 'иванов|п', 'Коммерческий директор', 'card', null), ('smirnova', 'смирнова|о', 'Менеджер по продажам', 'card', null), ('sbyt', null, null, null, 'NO_NAME')) t(who, key, title, method, reason)""")
def address_pairing(read):
    return pairing.candidates(_teams(read)).select("page_id", "email", "person_key", "title", "method", "reason")


def _judged(read):
    team = _teams(read)
    rules = verdicts.Rules(as_of=AS_OF)
    site = team.select("page_id", urls.own_site(HOSTED()).alias("site"))
    found = pairing.candidates(team).join(site, "page_id")
    atoms = pages.atom_rows(team).join(team.select("page_id", "url", "kind"), "page_id").join(site, "page_id")
    companies = site.select("site", F.lit("ООО Акме").alias("company"), F.col("site").alias("domain")).distinct()
    c = verdicts.in_context(found, companies, verdicts.site_facts(atoms, rules))
    return verdicts.per_address(verdicts.judged(c, rules), ["page_id"]), rules


@query("""select 'acme' || s_suppkey || '.example' as site, who || '@acme' || s_suppkey || '.example' as email, kind, reason, cast(stage as bigint) as stage from supplier cross join
(values ('info', 'generic', 'GENERIC', 2), ('ivanov', 'personal', null, 9), ('smirnova', 'personal', 'NOT_DM', 3), ('sbyt', 'generic', 'GENERIC', 2)) t(who, kind, reason, stage)""")
def judged_addresses(read):
    finals, _ = _judged(read)
    return finals.select("site", "email", "kind", "reason", n("stage").alias("stage"))


@query("""select 'acme' || s_suppkey || '.example' as site, 'ivanov@acme' || s_suppkey || '.example' as email, 'commercial' as role, cast(95 as bigint) as confidence from supplier""")
def leads_per_company(read):
    finals, rules = _judged(read)
    kept, _ = verdicts.leads(finals, rules)
    return kept.select("site", "email", "role", n("confidence").alias("confidence"))


@query("""select what, value, cast(n * (select count(*) from supplier) as bigint) as n from (values ('reason', 'GENERIC', 2), ('reason', 'NOT_DM', 1), ('kind', 'generic', 2), ('kind', 'personal', 2), ('status', 'lead', 1), ('status', 'no_lead', 3)) t(what, value, n)""")
def summary_of_results(read):
    finals, _ = _judged(read)
    s = verdicts.summary(finals.select(F.when(F.col("reason").isNull(), "lead").otherwise("no_lead").alias("status"), "role", "kind", "reason"))
    return s.filter("what in ('reason', 'kind', 'status') and value is not null")


@query("""select 'acme' || s_suppkey || '.example' as site, 'sbyt@acme' || s_suppkey || '.example' as contact from supplier""")
def general_contact(read):
    finals, _ = _judged(read)
    return verdicts.general_box(finals)


# --- checks of rows


def _rows(read):
    """A row for each page: a host that several rows share, a company that is the host's brand or another, and an address."""
    h = HOSTED()
    core = urls.core(h)
    k = F.col("page_id") % 5
    company = F.when(k == 4, F.lit("Zxqvw Kkjjx")).otherwise(core)
    email = F.when(k == 0, F.concat(F.lit("info@"), urls.registrable(h))).when(k == 1, F.lit("a@gmail.com")).when(k == 2, F.concat(F.lit("x"), "page_id", F.lit("@unlike.test"))).when(k == 3, F.lit("no address")).otherwise(F.lit(""))
    return read("pages").select(F.col("page_id").alias("row"), company.alias("company"), h.alias("domain"), email.alias("email"))


ROWS = f"""r as (select page_id as row, case when page_id % 5 = 4 then 'zxqvw kkjjx' else string_split(h, '.')[-2] end as company, h as domain, array_to_string(string_split(h, '.')[-2:], '.') as reg, case page_id % 5 when 0 then 'info@' || array_to_string(string_split(h, '.')[-2:], '.')
when 1 then 'a@gmail.com' when 2 then 'x' || page_id || '@unlike.test' when 3 then 'no' else '' end as email from (select page_id, {HOST} as h from pages))"""


@query(f"""with {ROWS}, k as (select row, company, 'site' as what, reg as key from r union all select row, company, 'email', case email when 'no' then 'no address' else email end from r where email <> ''),
g as (select what, key, count(*) as c, count(distinct company) as names from k group by all having count(*) > 1)
select row, string_agg('same ' || what || ' ' || case when names > 1 then 2 else 1 end, ',' order by what) as issues from k join g using (what, key) group by row""")
def cross_row_checks(read):
    return checks.cross_row(_rows(read)).select("row", F.array_join(F.array_sort(F.transform("issues", lambda x: F.concat_ws(" ", x["code"], x["level"].cast("string")))), ",").alias("issues"))


@query(f"""with {ROWS} select row, case row % 5 when 0 then 'own domain' when 1 then 'free mailbox' when 2 then 'another domain' when 3 then 'no address by its form' else 'no address' end as code, cast(case row % 5 when 0 then 0 when 4 then 0 else 2 end as bigint) as level from r""")
def check_email(read):
    site = read("pages").select(HOSTED().alias("domain"), "url", F.col("page_id").alias("place"), F.lit("").alias("html"))
    return checks.email_checked(_rows(read), site).select("row", F.col("issues")[0]["code"].alias("code"), n(F.col("issues")[0]["level"]).alias("level"))


@query(f"""with {ROWS} select row, case when row % 5 = 4 then 'another company''s site' else 'named by its site' end as code from r""")
def check_brand(read):
    p = pages.parsed(R.spread(read("pages"))).select(HOSTED().alias("domain"), F.col("page_id").alias("place"), "url", "page")
    return checks.brand_checked(_rows(read).filter("company <> ''"), p).select("row", F.col("issues")[0]["code"].alias("code"))


# --- facts and answers


@query(r"""with d as (select doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'), ' ')) as t, doc_id % 40 as item_id from documents), b as (select item_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'), ' ')) as q from benchmark),
w as (select doc_id, t, q, regexp_extract_all(q, '[\pL\p{Nd}]{3,}') as qw, list_distinct(regexp_extract_all(t, '[\pL\p{Nd}]{3,}')) as tw from d join b using (item_id))
select doc_id, contains(t, q) or (len(qw) >= 4 and len(list_filter(qw, lambda x: list_contains(tw, x))) >= 0.85 * len(qw)) as grounded from w""")
def grounded_quote(read):
    low = lambda c: F.lower(text.collapsed(F.col(c)))
    items = read("benchmark").select("item_id", low("text").alias("q"))
    d = read("documents").select("doc_id", low("text").alias("t"), (F.col("doc_id") % 40).alias("item_id"))
    return d.join(F.broadcast(items.filter("item_id between -39 and 39")), "item_id").select("doc_id", facts.is_grounded(F.col("q"), F.col("t")).alias("grounded"))  # all the items that a document can ask for


PAGE = "Завод Ромашка\n30.04.2024 Запустили новую линию резки на 2000 тонн в год\nСтанки для металла и дерева с доставкой"
ANSWERS = [
    ('{"personalization": "Увидели, что вы запустили новую линию резки на 2000 тонн", "source_url": "https://www.a.example/news/", "evidence": "Запустили новую линию резки на 2000 тонн в год", "date": "2024-04"}', "ACCEPTED"),
    ("no json", "NOT_JSON"), ('{"personalization": ""}', "EMPTY"), ('```json\n{"personalization": "нет данных", "reason": "x"}\n```', "NO_DATA"),
    ('{"personalization": "Увидели, что вы", "source_url": "http://b.example"}', "SOURCE"), ('{"personalization": "Увидели, что вы", "source_url": "http://a.example/news", "evidence": "коротко"}', "NO_QUOTE"),
    ('{"personalization": "Увидели, что вы", "source_url": "http://a.example/news", "evidence": "этого на странице никогда не было"}', "NOT_GROUNDED"),
    ('{"personalization": "Увидели, что вы нашли 555", "source_url": "http://a.example/news", "evidence": "Станки для металла и дерева"}', "NUMBERS"),
    ('{"personalization": "Увидели, что вы нашли 2000", "source_url": "http://a.example/news", "evidence": "Станки для металла и дерева"}', "NUMBERS_IN_QUOTE"),
    ('{"personalization": "We saw that you", "source_url": "http://a.example/news", "evidence": "Станки для металла и дерева"}', "LANGUAGE"),
    ('{"personalization": "Увидели, что вы делаете замечательные станки", "source_url": "http://a.example/news", "evidence": "Станки для металла и дерева"}', "CLICHE"),
    ('{"personalization": "Станки для металла и дерева у вас есть", "source_url": "http://a.example/news", "evidence": "Станки для металла и дерева"}', "OPENING"),
    ('{"personalization": "Увидели, что вы недавно сделали станки", "source_url": "http://a.example/news", "evidence": "Завод Ромашка и ещё станки; Станки для металла и дерева"}', "NOT_GROUNDED"),
]


def _answers(read):
    spark = read("region").sparkSession
    a = spark.createDataFrame([(i, "a", raw, wanted) for i, (raw, wanted) in enumerate(ANSWERS)], "answer_id long, site string, raw string, wanted string")
    s = spark.createDataFrame([("a", "https://a.example/news", "news", PAGE)], "site string, url string, kind string, content string")
    return facts.validated(a, s, AS_OF)


@query(f"""select answer_id, verdict from (values {", ".join(f"({i}::bigint, '{w}')" for i, (_, w) in enumerate(ANSWERS))}) t(answer_id, verdict)""")
def validated_answers(read):
    return _answers(read).select("answer_id", "verdict")


@query()
def sources_within_budget(read):
    lines = read("pages").select(HOSTED().alias("site"), "page_id", F.lit("home").alias("kind"), F.posexplode(html.lines(F.col("html"))).alias("place", "line"))
    titles = read("pages").select("page_id", html.title(F.col("html")).alias("title"))
    s = facts.sources(lines, titles, AS_OF)
    return s.select("site", "page_id", n("rank").alias("rank"), n(F.length("content")).alias("chars"))


# --- discovery and files

PROFILE = discovery.Profile(cities=["Paris"], domains=["ththan.net"], companies=["worse"], limit=20)


@query(f"""with r as (select page_id as place, replace({HOST}, '.example', '') as domain, case when page_id % 7 = 0 then 'worse' else 'fine' end as name, case when page_id % 5 = 0 then 'Rome' when page_id % 5 = 1 then 'Paris' else '' end as city from pages),
o as (select *, array_to_string(string_split(domain, '.')[-2:], '.') as own, string_split(domain, '.')[-2] as core from r),
l as (select *, case when name = 'worse' then 'excluded company worse' when core = 'ththan' then 'excluded domain ththan.net' when city = 'Rome' then 'city' when sha256(own) = sha256('thther.org') then 'opted out' end as late from o),
b as (select *, coalesce(sum(case when late is null then 1 else 0 end) over (partition by domain order by place rows between unbounded preceding and 1 preceding), 0) as kept_before from l),
d as (select *, case when kept_before > 0 then 'duplicate' else late end as drop from b), c as (select *, row_number() over (partition by drop order by place) as k from d)
select coalesce(case when drop is null and k > 20 then 'over limit' else drop end, 'kept') as drop_reason, cast(count(*) as bigint) as n from c group by 1""")
def discovery_drop_reasons(read):
    name, k = F.when(F.col("page_id") % 7 == 0, "worse").otherwise("fine"), F.col("page_id") % 5
    raw = read("pages").select(F.col("page_id").alias("place"), F.replace("url", F.lit(".example"), F.lit("")).alias("site"), name.alias("company"), F.when(k == 0, "Rome").when(k == 1, "Paris").otherwise("").alias("city"))
    listed = read("region").filter("r_regionkey = 0").select(text.hashed(F.lit("thther.org")).alias("sha256"))
    out = discovery.discovered([(discovery.seeds(raw, PROFILE, "pages"), False)], PROFILE, listed)
    return out.groupBy(F.coalesce("drop", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))


@query("""with r as (select c_custkey, c_mktsegment = 'BUILDING' as e, row_number() over (partition by c_mktsegment = 'BUILDING' order by c_custkey) k from customer) select c_custkey, case when e or k <= 50 then 'kept' else 'over limit' end as place from r""")
def explicit_limit_with_overflow(read):
    c = read("customer").select("c_custkey", (F.col("c_mktsegment") == "BUILDING").alias("whole"))
    return tables.limited_unless_explicit(c, ["c_custkey"], "whole", 50).select("c_custkey", "place")


@query("""with b as (select c_nationkey as nk, o_custkey, o_totalprice, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey desc) k from orders join customer on o_custkey = c_custkey),
g as (select *, row_number() over (partition by nk order by o_totalprice desc, o_orderkey desc, o_custkey desc) j from b where k = 1) select nk, o_custkey from g where j = 1""")
def argmax_two_level(read):
    o = read("orders").join(read("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nk")), "o_custkey")
    return tables.furthest(o, "nk", "o_custkey", ["o_totalprice", "o_orderkey"])


@query("""with l as (select doc_id, quality, case when quality = 1 then 'OK' when quality = 0 then 'BAD' end as status from labels) select 'matched' as route, cast(count(*) as bigint) as n from documents join l using (doc_id) where status = 'OK'
union all select 'unmatched', cast(count(*) as bigint) from documents left join l using (doc_id) where status is null union all select 'refused', cast(count(*) as bigint) from documents join l using (doc_id) where status <> 'OK'""")
def composite_join_routing(read):
    d = read("documents").select("doc_id", F.lower("lang").alias("lang"))
    hand = read("labels").join(d, "doc_id").select("doc_id", "lang", F.when(F.col("quality") == 1, "OK").when(F.col("quality") == 0, "BAD").alias("status"))
    out = None
    for name, df in tables.routed(d, hand, ["doc_id", "lang"], "OK").items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("route"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""select o_orderkey, case when o_totalprice < 20000 then 'small' when o_orderstatus = 'F' then 'closed' end as reason from orders where o_totalprice < 20000 or o_orderstatus = 'F'""")
def rejects_with_reason(read):
    reason = R.first_failed([("small", F.col("o_totalprice") < 20000), ("closed", F.col("o_orderstatus") == "F")])
    return tables.split_by_reason(read("orders"), reason)[1].select("o_orderkey", "reason")


@query("""select c_custkey, c_name from customer where ('0x' || substr(sha256('7|' || c_custkey), 1, 8))::bigint / 4294967296 < 0.25""")
def sample_by_key(read):
    return tables.picked_by_key(read("customer"), F.col("c_custkey").cast("string"), 0.25, "7").select("c_custkey", "c_name")


@query("""select d.doc_id, coalesce(case a.quality when 1 then 'good' when 0 then 'bad' end, '') as first_verdict, coalesce(case a.toxic when 1 then 'toxic' when 0 then 'clean' end, '') as second_verdict from documents d left join labels a using (doc_id)""")
def two_verdict_lookups(read):
    label = lambda c, one, none: read("labels").select("doc_id", F.when(F.col(c) == 1, one).when(F.col(c) == 0, none).alias("verdict"))
    return tables.two_verdicts(read("documents").select("doc_id"), label("quality", "good", "bad"), label("toxic", "toxic", "clean"), "doc_id")


@query("select s_suppkey, s_name, n_name from supplier join nation on s_nationkey = n_nationkey")
def dictionary_join_strict(read):
    d = read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return tables.looked_up(read("supplier"), d, "s_nationkey", "n_name").select("s_suppkey", "s_name", "n_name")


@query("select c_custkey, c_name, c_mktsegment from customer")
def passthrough_reorder_drop_empty(read):
    c = tables.with_appended(read("customer").select("c_custkey", "c_mktsegment", "c_name"), {"empty": F.lit(""), "blank": F.lit(None).cast("string")})
    c = c.select(*tables.placed_after(c.columns, "c_custkey", ["c_name"]))
    return tables.without_empty(c)


@query("select c_custkey, c_name from customer where c_custkey % 10 <> 0")
def resume_with_markers(read):
    rows = read("customer").withColumn("key", discovery.row_key(F.col("c_name"), F.lit("https://www.A.example/x"), F.col("c_mktsegment")))
    done = rows.filter("c_custkey % 5 = 0").withColumn("comment", F.when(F.col("c_custkey") % 10 == 0, "done").otherwise("site down: retry"))
    return discovery.to_do(rows, done, "comment", ["retry"]).select("c_custkey", "c_name")


@query("""select c_custkey, case when c_custkey % 4 = 0 then case when c_custkey % 8 = 0 then 'error' else 'late' end else 'ok' end as status from customer""")
def retry_failed(read):
    seen = []

    def run(df):
        seen.append(1)
        k, again = F.col("c_custkey"), len(seen) > 1
        return df.withColumn("status", F.when(k % 4 != 0, "ok").when((k % 8 != 0) & F.lit(again), "late").otherwise("error"))

    return discovery.retried(run, read("customer").select("c_custkey"), 2)


@query("""select 's' || c_custkey % 50 || '.example' as site, 'u' || c_custkey || '@s' || c_custkey % 50 || '.example' as email, 'write to [removed] now' as note from customer where c_custkey % 50 <> 7""")
def opt_out_domain(read):
    k = F.col("c_custkey")
    site = F.concat(F.lit("s"), (k % 50).cast("string"), F.lit(".example"))
    leads = read("customer").select(site.alias("site"), F.concat(F.lit("u"), k, F.lit("@"), site).alias("email"), F.col("c_name").alias("surname"), F.lit("").alias("first"), F.lit("write to x@s7.example now").alias("note"))
    return discovery.opted_out(leads, "s7.example", ["note"])[0].select("site", "email", "note")


@query("""with r as (select 's' || c_custkey % 50 || '.example' as site from customer) select site, case when site = 's7.example' then 'no_lead' else 'lead' end as status, cast(case when site = 's7.example' then count(*) else 0 end as bigint) as removed from r group by site""")
def opt_out_tombstones(read):
    site = F.concat(F.lit("s"), (F.col("c_custkey") % 50).cast("string"), F.lit(".example"))
    leads = read("customer").select(site.alias("site"), F.concat(F.lit("u@"), site).alias("email"), F.col("c_name").alias("surname"), F.lit("").alias("first"))
    return discovery.opted_out(leads, "s7.example", [])[2]


@query("""select s_suppkey as page_id, cast(k as bigint) as place, 'https://a.example/' || s_suppkey || '?x=1&y=' || k as link from supplier cross join (values (0), (1)) t(k)""")
def sitemap_urls(read):
    xml = F.concat(*[x for k in (0, 1) for x in (F.lit("<url><loc> https://a.example/"), F.col("s_suppkey").cast("string"), F.lit(f"?x=1&amp;y={k}</loc></url>"))])
    return discovery.sitemap_links(read("supplier").select(F.col("s_suppkey").alias("page_id"), xml.alias("xml"))).select("page_id", n("place").alias("place"), "link")


@query("""select s_suppkey as page_id, cast(k as bigint) as place, case k when 0 then 'Name|Country' else s_name || '|Россия' end as cells from supplier cross join (values (0), (1)) t(k)""")
def catalogue_tables(read):
    h = F.concat(F.lit("<table><tr><th>Name<th><TH>Country</th></tr><tr class=x><td><a href='/x'>"), F.col("s_name"), F.lit("</a></td><td> Россия </td></tr></table>"))
    t = discovery.table_entries(read("supplier").select(F.col("s_suppkey").alias("page_id"), F.regexp_replace(h, "<th>Name<th>", "<th>Name</th>").alias("html")))
    return t.select("page_id", n("place").alias("place"), F.array_join("cells", "|").alias("cells"))


@query("""select s_suppkey, 'a.example' as site, 'Россия' as country from supplier""")
def catalogue_details(read):
    d = discovery.definitions(F.concat(F.lit("<dl><dt>Сайт</dt><dd><a>a.example</a></dd><dt>Страна</dt><dd>Россия</dd><dt>Сайт</dt><dd>b"), F.col("s_suppkey"), F.lit("</dd></dl>")))
    return read("supplier").select("s_suppkey", F.element_at(d, "Сайт").alias("site"), F.element_at(d, "Страна").alias("country"))


@query("""select s_suppkey * 1000 as place, 'Acme' || s_suppkey as name, 'acme' || s_suppkey || '.example' as domain from supplier""")
def search_result_companies(read):
    raw = F.concat(F.lit('{"organic":[{"title":"Станки — Acme'), "s_suppkey", F.lit('","link":"https://acme'), "s_suppkey", F.lit('.example/a/b"},{"title":"x","link":"https://vk.com/acme"},{"title":"Deep | Page","link":"https://other.example/a/b/c"}]}'))
    return discovery.search_results(read("supplier").select(F.col("s_suppkey").alias("place"), raw.alias("raw"))).select("place", "name", "domain")


@query("""select s_suppkey as doc, 'Part two' as section, cast(k as bigint) as row, case k when 1 then 'a,b' when 2 then s_suppkey || ',x|y' end as cells from supplier cross join (values (1), (2)) t(k)""")
def markdown_tables(read):
    lines = ["# Part one", "text", "## Part two", "| a | b |", "| --- | :-: |", None, "", "end"]
    each = F.array(*[F.concat(F.lit("| "), F.col("s_suppkey").cast("string"), F.lit(" | x\\|y |")) if x is None else F.lit(x) for x in lines])
    t = tables.markdown_tables(read("supplier").select(F.col("s_suppkey").alias("doc"), F.posexplode(each).alias("place", "line")))
    return t.select("doc", "section", n("row").alias("row"), F.array_join("cells", ",").alias("cells"))


# --- campaigns


@query("""select c_custkey, cast(20 as bigint) as gap, cast(null as bigint) as far, true as printed, true as labelled from customer""")
def evidence_on_page(read):
    page = F.concat(F.lit("<p>Иванов Пётр, <b>директор</b> по сбыту</p> <a href='mailto:i"), "c_custkey", F.lit("@a.example'>i"), "c_custkey", F.lit("@a.example</a>"), F.lit("<p>"), F.rpad(F.lit(""), 400, "x"), F.lit(" Петров</p>"))
    e = F.concat(F.lit("i"), "c_custkey", F.lit("@a.example"))
    c = R.spread(read("customer").select("c_custkey")).select("c_custkey", page.alias("page"), e.alias("e"))
    gap = fixed.let(campaign.distance(F.col("page"), F.col("e"), F.lit("директор")), lambda g: F.when(g.between(5, 25), 20).otherwise(g))
    return c.select("c_custkey", n(gap).alias("gap"), n(campaign.distance(F.col("page"), F.col("e"), F.lit("Петров"))).alias("far"), campaign.is_printed(F.col("page"), F.col("e")).alias("printed"), campaign.is_labelled(F.col("page"), F.col("e"), F.lit("Сбыту")).alias("labelled"))


@query("""select c_custkey, case when c_custkey % 2 = 0 and c_custkey % 3 = 0 and c_custkey % 5 = 0 then 'A' when c_custkey % 2 = 0 or c_custkey % 7 = 0 then 'B' else 'C' end as priority, case when c_custkey % 7 = 0 and c_custkey % 5 = 0 then 'A' when c_custkey % 7 = 0 then 'B' else 'C' end as level,
case when c_custkey % 7 = 0 and c_custkey % 5 = 0 then 'b' else 'a' end as x, cast((2024 - 1990 - c_custkey % 30) * 12 + 5 as bigint) as months from customer""")
def enrichment_decisions(read):
    k = F.col("c_custkey")
    event, named, by_name = k % 2 == 0, k % 7 == 0, k % 5 == 0
    level = campaign.contact_level(named, by_name, F.lit(True))
    return read("customer").select("c_custkey", campaign.priority(F.lit(""), event, F.when(k % 3 == 0, "sales").otherwise("other"), named, by_name).alias("priority"), level["level"].alias("level"),
                                   F.when(level["variant"] == "c", "b").otherwise("a").alias("x"), n(campaign.months_old((F.lit(1990) + k % 30).cast("string"), AS_OF)).alias("months"))


@query("""select c_custkey as contact, cast(step as bigint) as step, case step when 1 then 'Hello, ' || c_name else 'Re: Hello, ' || c_name end as subject,
case when ('0x' || substr(sha256('s|' || c_custkey || '|' || step), 1, 7))::bigint % 2 = 0 then 'Good day' else 'Greetings' end || ', ' || c_name || '. {{unknown}}' as body from customer cross join (values (1), (2)) t(step) where c_custkey < 300""")
def rendered_letters(read):
    c = read("customer").filter("c_custkey < 300").select(F.col("c_custkey").alias("contact"), F.lit("a").alias("variant"), F.create_map(F.lit("name"), F.col("c_name")).alias("values"))
    body = "{{RANDOM Good day, Greetings}}, {{name}}. {{unknown}}"
    steps = c.sparkSession.createDataFrame([(1, "a", "Hello, {{name}}", body), (2, None, "", body), (1, "b", "x", "y")], "step int, variant string, subject string, body string")
    return campaign.letters(c, steps, "s").select("contact", n("step").alias("step"), "subject", "body")


@query("""with k as (select c_custkey, row_number() over (order by c_custkey) as n from customer where c_custkey < 70) select c_custkey, case when n <= 20 then 'A' when n <= 40 then 'B' when n <= 60 then 'C' end as batch, case when n % 2 = 1 then 'one' else 'two' end as mailbox from k""")
def named_batches(read):
    return campaign.batches(read("customer").filter("c_custkey < 70").select("c_custkey"), [("A", 20), ("B", 20), ("C", 20)], ["c_custkey"], ["one", "two"])


@query("""select * from (values ('no batch', '60@a.example'), ('no batch', '61@a.example'), ('repeated', '7@a.example')) t(problem, key)""")
def export_constraints(read):
    c = read("customer").filter("c_custkey < 62").select("c_custkey", F.concat(F.when(F.col("c_custkey") == 8, 7).otherwise(F.col("c_custkey")).cast("string"), F.lit("@a.example")).alias("email"), "c_name")
    c = campaign.batches(c, [("A", 20), ("B", 20), ("C", 20)], ["c_custkey"], ["one", "two"]).withColumns({"stratum": F.lit("s"), "arm": F.when(F.col("c_custkey") % 2 == 0, "A").otherwise("B")})
    return campaign.export_problems(c, [("A", 20), ("B", 20), ("C", 20)], ["c_name"])


@query("""select 'x' as letter, side, line from (values ('document', 'only here'), ('table', 'only there')) t(side, line)""")
def document_consistency(read):
    spark = read("region").sparkSession
    d = spark.createDataFrame([("x", "same\nonly here\n\nboth ")], "letter string, text string")
    return campaign.line_differences(d, spark.createDataFrame([("x", "both\nonly there\nsame")], "letter string, text string"))


@query("""select s_suppkey as doc, 'Letter ' || s_suppkey as heading, 'one' || chr(10) || 'two' as text from supplier""")
def fenced_letters(read):
    lines = F.array(F.concat(F.lit("## Letter "), F.col("s_suppkey").cast("string")), *map(F.lit, ["before", "```", "one", "two", "```", "after"]))
    return campaign.fenced_blocks(read("supplier").select(F.col("s_suppkey").alias("doc"), F.posexplode(lines).alias("place", "line"))).select("doc", "heading", "text")


@query("""select (select string_agg(o_orderstatus || ' ' || n, ', ' order by n desc, o_orderstatus) from (select o_orderstatus, count(*) as n from orders group by 1)) as line""")
def counts_in_a_line(read):
    return campaign.counts_line(read("orders"), "o_orderstatus")


@query("""select cast(place as integer) as place, stage, cast(n as bigint) as n from (select 0 as place, 'all' as stage, count(*) as n from orders union all select 1, 'open', count(*) from orders where o_orderstatus = 'O' union all select 2, 'large', count(*) from orders where o_orderstatus = 'O' and o_totalprice > 100000)""")
def funnel_stages(read):
    return campaign.funnel(read("orders"), [("all", F.lit(True)), ("open", F.col("o_orderstatus") == "O"), ("large", F.col("o_totalprice") > 100000)])


@query("""select o_orderkey, case when o_orderkey % 10 = 1 and o_orderkey % 100 <> 11 then 'письмо' when o_orderkey % 10 between 2 and 4 and not o_orderkey % 100 between 12 and 14 then 'письма' else 'писем' end as noun from orders""")
def plural_nouns(read):
    return read("orders").select("o_orderkey", campaign.plural(F.col("o_orderkey"), "письмо", "письма", "писем").alias("noun"))


# --- streams


def _events(read):
    spark = read("region").sparkSession
    source = read("events")
    folder = source.inputFiles()[0].rpartition("/")[0]
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet*").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))



@query("select user_id, event_type, cast(1 as bigint) as n from events group by all")
def stream_dedup_watermark(read):
    """The stream's first batch holds the whole file, so each key comes once."""
    once = streams.distinct_within(_events(read), "ts", ["user_id", "event_type"], "3650 days").select("user_id", "event_type")
    return streams.run(once, "append").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("""with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hour then 0 else 1 end as c from events), s as (select *, sum(c) over (partition by user_id order by ts rows unbounded preceding) as k from e)
select user_id, min(ts) as start, cast(count(*) as bigint) as n from s group by user_id, k""")
def stream_session(read):
    return streams.run(streams.sessions(_events(read), "ts", ["user_id"], "6 hours"), "complete").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("select time_bucket(interval 1 day, ts) as start, event_type, cast(count(*) as bigint) as n from events group by all")
def stream_windows(read):
    return streams.run(streams.windowed(_events(read), "ts", ["event_type"], "1 day"), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")
