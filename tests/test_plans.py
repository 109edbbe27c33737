"""People, pages, verdicts, checks, facts, files and letters against what a reader sees."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F

from sitesieve.functions import dates, fuzzy, markup, people, text
from sitesieve.operators import relational as R
from sitesieve.plans import campaign, checks, discovery, facts, pages, pairing, verdicts
from sitesieve.sources import tables

DAY = datetime.date(2026, 10, 3)


def value(spark, f, *given):
    df = spark.createDataFrame([given], ", ".join(f"c{i} string" for i in range(len(given))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(given))])).first()[0]


@pytest.mark.parametrize(
    "line, wanted",
    [
        ("03/19/2026", ["2026-03-19"]), ("19.03.2026, 2026-03-20", ["2026-03-19", "2026-03-20"]), ("30 сентября 2026", ["2026-09-30"]), ("сентябрь 2026", ["2026-09-30"]), ("Весна 2026", ["2026-04-30"]),
        ("March 5, 2025 and 5 Mar 2025", ["2025-03-05", "2025-03-05"]), ("2026年3月19日", ["2026-03-19"]), ("31.02.2024", []), ("1989-05-05", []), ("since 2009", []), ("мая 2024", ["2024-05-31"]),
    ],
)
def test_dates_in_text(line, wanted):
    assert [str(d) for _, _, d in dates.spans_of(line, DAY)] == wanted


def test_entry_days(spark):
    entry = lambda c: dates.entry_day(c, dates.spans(c, DAY))
    assert str(value(spark, entry, "30.09.2026 Релиз 89g")) == "2026-09-30" and str(value(spark, entry, "1 октября 2026 Читать ~ 8 мин")) == "2026-10-01"
    assert value(spark, entry, "Требования к оборудованию, актуальные на сентябрь 2026, описаны в статье") is None


def test_names():
    find = lambda x: [(p.surname, p.first, p.patronymic, p.kind) for _, _, p in people.Names().find(x)]
    assert find("Иванов Пётр Ильич") == [("Иванов", "Пётр", "Ильич", "full")] and find("Пётр Ильич Иванов") == [("Иванов", "Пётр", "Ильич", "full")]
    assert find("Пётр Ильич") == [("", "Пётр", "Ильич", "no_surname")] and find("ИВАНОВ ПЁТР") == [("Иванов", "Пётр", "", "full")]
    assert find("Петров А. Б., В.Г. Сидоров") == [("Петров", "А.", "Б.", "initials"), ("Сидоров", "В.", "Г.", "initials")]
    assert find("ул. Ивана Франко, Генеральный Директор, Нижний Новгород") == []
    assert find("John Smith and Sales Manager") == [("Smith", "John", "", "latin")]
    assert find("Aлексей Иванов") == [("Иванов", "Алексей", "", "full")]  # the first letter is Latin
    assert find("Примеров Зульфат, коммерческий директор") == [("Примеров", "Зульфат", "", "full")] and find("Примеров Зульфат") == []


@pytest.mark.parametrize(
    "local, person, wanted",
    [
        ("ivanov", ("Иванов", "Пётр", "Ильич", "full"), "surname"), ("p.ivanov", ("Иванов", "Пётр", "", "full"), "surname"), ("ivanof", ("Иванов", "Пётр", "", "full"), "surname"), ("petr", ("Сидоров", "Пётр", "", "full"), "first"),
        ("alex", ("Сидоров", "Александр", "", "full"), "first"), ("ipi", ("Иванов", "Пётр", "Ильич", "full"), "initials"), ("obpi", ("Образцов", "Пётр", "Ильич", "full"), "initials"), ("sales", ("Иванов", "Пётр", "", "full"), ""), ("117", ("Иванов", "Пётр", "", "full"), ""),
    ],
)
def test_mailboxes_that_fit_people(local, person, wanted):
    assert fuzzy.local_fits(local, *person, people.ALIASES) == wanted


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("Генеральный директор", "ceo"), ("Менеджер по продажам", "staff"), ("Начальник отдела продаж", "sales"), ("Директор по маркетингу", "marketing"), ("Директор по развитию", "bizdev"), ("Коммерческий директор", "commercial"),
        ("Заместитель генерального директора - начальник службы качества", "dept_head"), ("Технический директор", "other_director"), ("Региональный директор", "branch"), ("Руководитель отдела логистики", "dept_head"), ("CEO", "ceo"), ("Founder", "ceo"),
    ],
)
def test_roles(spark, title, wanted):
    assert value(spark, people.role, title).role == wanted


def test_titles_and_addresses():
    assert [x for _, _, x in people.titles("Коммерческий директор: Иванов. Менеджеры. к директору. Head of sales | x", [])] == ["Коммерческий директор", "Head of sales"]
    assert [x for _, _, x in people.emails("a@b.ru, sales [at] site [dot] ru info@site .com logo@2x.png name@x.ru")] == ["a@b.ru", "sales@site.ru", "info@site.com"]


def test_atoms_and_page_records():
    d = markup.flattened("http://a.ru/x", "<title>T</title><body><nav><a href='/n'>N</a></nav><main><h2>Команда</h2><div class='b a'><p>Иванов<br>Пётр</p><a href='mailto:p@a.ru?subject=x'>write</a></div><!--x--></main><footer>f</footer>", people.lone_word)
    assert [(a.text, a.chrome, a.section, a.mailto) for a in d.atoms] == [("N", True, "", ()), ("Команда", False, "", ()), ("Иванов Пётр", False, "Команда", ()), ("write", False, "Команда", ("p@a.ru",)), ("f", True, "Команда", ())]
    assert d.text == " ".join(a.text for a in d.atoms) and all(d.text[a.start : a.start + len(a.text)] == a.text for a in d.atoms) and "div.a.b" in d.kinds.values()
    p = markup.page_of("http://a.ru/", "<title>A &amp; B</title><meta property='og:site_name' content='Brand'><img src=logo.png alt='The Logo'><h1>Head</h1><nav><a href=x>menu</a></nav><p>Some <b>long</b> line</p><footer>© 2024 A</footer>")
    assert (p["title"], p["site_name"], p["logos"], p["lines"], p["copyright"], p["links"]) == ("A & B", "Brand", ["The Logo"], ["A & B", "Head", "Some long line"], ["© 2024 A"], [{"href": "http://a.ru/x", "text": "menu"}])


def test_charsets_and_protected_addresses(spark):
    rows = [("Ёж".encode("cp1251"), ""), ("Ёж".encode(), "text/html; charset=utf-8"), (b"<meta charset=gb2312>" + "中".encode("gb18030"), ""), ("ü".encode("latin-1"), "charset=iso-8859-1")]
    assert [r[0][-2:] for r in spark.createDataFrame(rows, "c binary, t string").select(markup.decoded("c", "t")).collect()] == ["Ёж", "Ёж", ">中", "ü"]
    code = "".join(f"{b:02x}" for b in [0x2A, *(0x2A ^ x for x in b"p@a.ru")])
    assert value(spark, markup.protected, code) == "p@a.ru" == markup.unprotected(code) and value(spark, markup.protected, "zz") == ""


def test_pairing_reads_cards_rows_and_lists():
    page = lambda body: [(c["email"], c.get("person_key"), c.get("title"), c.get("method"), c.get("reason")) for c in pairing.Page("http://a.ru/", f"<body>{body}</body>", people.Names(), people.ALIASES).candidates()]
    table = "<table><tr><td>Иванов Пётр</td><td>Директор</td><td>ivanov@a.ru</td></tr><tr><td>Смирнова Ольга</td><td>Бухгалтер</td><td>smirnova@a.ru</td></tr></table>"
    assert page(table) == [("ivanov@a.ru", "иванов|п", "Директор", "card", None), ("smirnova@a.ru", "смирнова|о", "Бухгалтер", "card", None)]
    assert page("<p>Директор Иванов Пётр, Смирнова Ольга<br>x1@a.ru<br>x2@a.ru</p>") == [("x1@a.ru", "иванов|п", "Директор", "zip", None), ("x2@a.ru", "смирнова|о", None, "zip", None)]
    assert [r[3:] for r in page("<p>Иванов Пётр, Смирнова Ольга<br>box@a.ru</p>")] == [(None, "AMBIGUOUS")]
    assert [r[3:] for r in page("<p>Отдел сбыта<br>box@a.ru</p>")] == [(None, "NO_NAME")]
    assert [r[4] for r in page("<footer>info@a.ru</footer>")] == ["GENERIC"]


def judged(spark, **change):
    row = {"site": "a.ru", "email": "ivanov@a.ru", "url": "https://a.ru/team", "visible": True, "chrome": False, "surname": "Иванов", "first": "Пётр", "patronymic": "", "person_kind": "full", "person_key": "иванов|п", "agreement": "surname", "title": "Коммерческий директор",
           "dept": "", "gap": 10, "title_gap": 5, "method": "card", "title_adjacent": True, "in_card": True, "section": "", "reason": "", "digits": [], "fragment": "", "page_id": 1, **change}
    facts_ = {"last_day": None, "feed_day": None, "footer_year": 2026, "staff": 0, "ban_url": None, "refusal_url": None, "updated": None}
    facts_ |= {k: row.pop(k) for k in list(row) if k in facts_}
    schema = "site string, email string, url string, visible boolean, chrome boolean, surname string, first string, patronymic string, person_kind string, person_key string, agreement string, title string, dept string, gap int, title_gap int, method string, title_adjacent boolean, in_card boolean, section string, reason string, digits array<string>, fragment string, page_id int"
    c = spark.createDataFrame([tuple(row.values())], schema)
    f = spark.createDataFrame([("a.ru", *facts_.values())], "site string, last_day date, feed_day date, footer_year int, staff int, ban_url string, refusal_url string, updated map<string,date>")
    companies = spark.createDataFrame([("a.ru", "Акме", "a.ru")], "site string, company string, domain string")
    out = spark.createDataFrame([], "sha256 string") if "suppressed" not in change else change["suppressed"]
    r = verdicts.judged(verdicts.in_context(c, companies, f, out), verdicts.Rules(as_of=DAY)).first()
    return r.reason, r.stage, r.confidence


def test_verdicts_in_their_order(spark):
    old = datetime.date(2020, 1, 1)
    assert judged(spark) == (None, 9, 95)
    cases = [
        ({"email": "a..b@a.ru"}, "SYNTAX"), ({"email": "x@gmail.com"}, "FREE"), ({"email": "ivanov@other.ru"}, "DOMAIN"), ({"email": "info@a.ru", "agreement": ""}, "GENERIC"), ({"person_key": None, "agreement": "surname"}, "NO_NAME"), ({"agreement": ""}, "UNMATCHED"),
        ({"title": ""}, "NO_TITLE"), ({"title_gap": 351}, "NO_TITLE"), ({"title": "Менеджер"}, "NOT_DM"), ({"title": "Технический директор"}, "ROLE"), ({"section": "Отзывы клиентов"}, "FOREIGN"), ({"gap": 351}, "GAP"), ({"visible": False}, "MAILTO"),
        ({"ban_url": "u"}, "PD_BAN"), ({"refusal_url": "u"}, "REFUSAL"), ({"updated": {"https://a.ru/team": old}}, "STALE"), ({"feed_day": old, "footer_year": 2020, "last_day": old}, "STALE"), ({"method": "zip", "agreement": "", "email": "gd@a.ru", "person_kind": "initials", "title_adjacent": False}, "LOW"),
    ]
    for change, reason in cases:
        assert judged(spark, **change)[0] == reason, change


def test_rows_that_do_not_fit_their_sites(spark):
    rows = spark.createDataFrame([(1, "ООО Ромашка", "romashka.ru", "info@romashka.ru"), (2, "Лютик", "romashka.ru", "a@mail.ru"), (3, "Василёк", "vasilek.ru", "sale01@vasilek.ru"), (4, "Пион", "pion.ru", "x@pion-group.ru")], "row int, company string, domain string, email string")
    html = {"romashka.ru": "<title>Ромашка</title> info@romashka.ru", "vasilek.ru": "<title>Василёк</title> sales01@vasilek.ru", "pion.ru": "<title>中国</title>"}
    p = pages.parsed(spark.createDataFrame([(d, 0, f"https://{d}/", h) for d, h in html.items()], "domain string, place int, url string, html string"))
    brand = {r.row: r.issues[0]["code"] for r in checks.brand_checked(rows, p).collect()}
    assert brand == {1: "named by its site", 2: "another company's site", 3: "named by its site", 4: "named by its site"}
    email = {r.row: (r.issues[0]["level"], r.issues[0]["code"]) for r in checks.email_checked(rows, p).collect()}
    assert email == {1: (0, "printed"), 2: (2, "free mailbox"), 3: (1, "a like address is printed"), 4: (1, "shares a part")}
    assert {r.row for r in checks.cross_row(rows).collect()} == {1, 2}
    assert {r.row: r.status for r in checks.checked(rows, p).collect()} == {1: "MISMATCH", 2: "MISMATCH", 3: "REVIEW", 4: "REVIEW"}
    assert {r.row: r.owner for r in checks.owners(rows).collect()} == {2: "ООО Ромашка"}


def test_sources_facts_and_grounding(spark):
    lines = [("s", 1, "news", i, x) for i, x in enumerate(["Меню", "12.09.2026", "Запустили линию резки на новом заводе в Туле и наняли людей", "01.02.2020 Старая запись о том, как завод открылся для всех", "y" * 50])] + [("s", 2, "home", 0, "x" * 4000)]
    df = spark.createDataFrame(lines, "site string, page_id int, kind string, place int, line string")
    entries = facts.dated_entries(df, DAY, ["site", "page_id"])
    assert [(str(r.day), r.text.split()[0]) for r in entries.orderBy("rank").collect()] == [("2026-09-12", "Меню"), ("2020-02-01", "01.02.2020")]
    assert [str(r.day) for r in facts.freshest(entries, DAY).collect()] == ["2026-09-12"]
    s = facts.sources(df, spark.createDataFrame([(1, "T"), (2, "")], "page_id int, title string"), DAY).orderBy("rank").collect()
    assert [r.page_id for r in s] == [1, 2] and s[0].content.startswith("# T\nМеню 12.09.2026") and len(s[1].content) <= 3500
    g = lambda q, c: value(spark, facts.is_grounded, q, c)
    assert g("one two … three", "three and one two") and not g("one two four", "one two three") and g("alpha beta gamma delta epsilon zeta eta", "eta zeta epsilon delta gamma beta alpha x") and not g("", "x")


def test_distinct_pages_depend_on_what_was_kept(spark):
    df = spark.createDataFrame([("s", 1, "u1", "t1"), ("s", 2, "u1", "t2"), ("s", 3, "u2", "t2"), ("s", 4, "u3", "t1")], "site string, o int, u string, t string")
    assert sorted(r.o for r in pages.distinct_pages(df, "site", "o", "u", "t").collect()) == [1, 3]


def test_files_there_and_back(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Компания;Сайт\nООО «Ёж»;\"a;b\"\n".encode("cp1251"))
    (tmp_path / "b.csv").write_bytes("﻿company,site\nx,\n".encode())
    a = tables.renamed(tables.read_csv(spark, str(tmp_path / "a.csv")), discovery.ALIASES, ("name", "site"))
    assert [tuple(r) for r in a.collect()] == [("ООО «Ёж»", "a;b")] and a.columns == ["name", "site"]
    b = tables.read_csv(spark, str(tmp_path / "b.csv"))
    assert b.columns == ["company", "site"] and [tuple(r) for r in b.collect()] == [("x", "")]
    with pytest.raises(ValueError):
        tables.renamed(b.select("company"), discovery.ALIASES, ("site",))
    df = spark.createDataFrame([(1, 'q"u,o', None), (2, "x|y", "")], "n int, s string, e string")
    tables.write_csv(df, str(tmp_path / "o.csv"), ["n", "s"])
    assert (tmp_path / "o.csv").read_bytes() == b'\xef\xbb\xbfn,s\r\n1,"q""u,o"\r\n2,x|y\r\n'
    tables.write_json(df, str(tmp_path / "o.json")), tables.write_markdown(df, str(tmp_path / "o.md"), "T"), tables.write_workbook({"One": df}, str(tmp_path / "o.xlsx"))
    assert "| 2 | x\\|y |  |" in (tmp_path / "o.md").read_text() and '"s": "x|y"' in (tmp_path / "o.json").read_text()
    assert b"<v>2</v>" in zipfile.ZipFile(tmp_path / "o.xlsx").read("xl/worksheets/sheet1.xml")
    (tmp_path / "p").mkdir()
    for name in ("one.checked.csv", "two.checked.csv"):
        (tmp_path / "p" / name).write_text("k,v\n1,a\n")
    assert {r.batch for r in tables.by_file(spark, str(tmp_path / "p" / "*.csv")).collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        tables.parts(spark, str(tmp_path / "p" / "*.csv"), "k")
    (tmp_path / "l.txt").write_text("a.ru\n\nb.ru\n")
    assert [r.site for r in tables.read_list(spark, str(tmp_path / "l.txt")).orderBy("place").collect()] == ["a.ru", "b.ru"]
    with pytest.raises(ValueError):
        tables.looked_up(df, df.filter("n = 1").select("n", F.lit("z").alias("z")), "n", "z").count()


def test_profile(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"roles": ["sales"], "cities": ["Тула"], "segments": [{"name": "metal", "keywords": ["металл", "станк"]}], "exclude": {"companies": ["Гигант"], "domains": ["primer.ru"]}}')
    p = discovery.Profile.read(tmp_path / "p.json")
    df = spark.createDataFrame([("Гигант Плюс", "a.ru", "Тула"), ("Гигантский", "primer.com", ""), ("Станкомаш", "b.ru", "Орёл")], "n string, d string, c string")
    got = df.select(p.excluded(F.col("n"), F.col("d")).alias("e"), p.city_fits(F.col("c")).alias("c"), p.segment(F.col("n")).alias("s")).collect()
    assert [tuple(r) for r in got] == [("excluded company Гигант", True, ""), ("excluded domain primer.ru", True, ""), (None, False, "metal")]
    assert [r["query"] for r in p.queries(spark).orderBy("place").collect()] == ["металл Тула", "станк Тула"]
    (tmp_path / "q.json").write_text('{"roles": ["nobody"]}')
    with pytest.raises(ValueError):
        discovery.Profile.read(tmp_path / "q.json")


def test_opt_out_twice_changes_nothing(spark):
    leads = spark.createDataFrame([("a.ru", "x@a.ru", "Иванов", "Пётр", "see x@a.ru"), ("b.ru", "y@b.ru", "", "", "with X@A.ru, xx@a.ru")], "site string, email string, surname string, first string, note string")
    left, hashes, sites = discovery.opted_out(leads, "x@a.ru", ["note"])
    assert [tuple(r)[-1] for r in left.collect()] == ["with [removed], xx@a.ru"] and {(r.site, r.status) for r in sites.collect()} == {("a.ru", "no_lead"), ("b.ru", "lead")}
    assert hashes.count() == 2 and discovery.opted_out(left, "x@a.ru", ["note"])[0].collect() == left.collect()
    person = text.person_hash(F.lit("Иванов"), F.lit("П"), F.lit("a.ru"))
    assert hashes.filter(F.col("sha256") == person).count() == 1


def test_near_strings_like_all_pairs(spark):
    import random

    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(0, 5))) for _ in range(120)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {(r.a, r.b) for r in R.near_strings(df, "w", 2).collect()}
    pairs = df.select(F.col("w").alias("a")).crossJoin(df.select(F.col("w").alias("b"))).filter("a < b and levenshtein(a, b) <= 2")
    assert got == {(r.a, r.b) for r in pairs.collect()}


def test_letters_and_problems(spark):
    assert value(spark, campaign.options, "{{RANDOM a b c, d}}! {{name}}") == "a b c! {{name}}"
    df = spark.createDataFrame([("S", "Hi {{x}} [y]", 500), ("", "b", 1), ("S", "ok", 2)], "subject string, body string, words int")
    assert [r.problems for r in campaign.letter_problems(df).collect()] == [["variables left", "brackets", "too long"], ["empty"], []]
    assert value(spark, lambda a, b: campaign.is_run_of(a, b), "директор по сбыту", "Главный директор по сбыту, Тула") and not value(spark, lambda a, b: campaign.is_run_of(a, b), "директор сбыту", "директор по сбыту")
    assert value(spark, lambda a, b: campaign.same_site(a, b), "https://shop.a.ru/x", "a.ru") and not value(spark, lambda a, b: campaign.same_site(a, b), "ba.ru", "a.ru")
    assert value(spark, campaign.paragraph_differences, "a\n\nb\n\nc", "a\n\nB") == [2, 3]
    assert value(spark, lambda m: campaign.section(m, "Two"), "# One\nx\n## Two\ny\nz\n# Three\n") == "y\nz"


def test_a_site_of_many_rows_and_pages_makes_no_pairs(spark):
    names = ["Zxqvw Kkjjx", "Acme", "ACME ", "Acme Sale"]
    rows = spark.range(4000).select(F.col("id").alias("row"), F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 4 + 1).cast("int")).alias("company"), F.lit("acme.ru").alias("domain"))
    owned = checks.owners(rows)
    assert {(r.row % 4, r.owner) for r in owned.collect()} == {(0, "Acme"), (1, "Acme Sale"), (2, "Acme Sale"), (3, "Acme")}
    html = F.concat(F.lit("<title>Acme</title><p>Text "), F.col("id") % 50, F.lit(" names Zxqvw"))
    p = pages.parsed(spark.range(400).select(F.lit("acme.ru").alias("domain"), F.col("id").alias("place"), F.lit("https://acme.ru/").alias("url"), html.alias("html")))
    found = checks.zones(p).filter("zone is not null")
    assert found.count() < 100  # the distinct words, not those of all pages
    assert {(r.row % 4, r.issues[0]["code"]) for r in checks.brand_checked(rows, p).collect()} == {(0, "named in text only"), (1, "named by its site"), (2, "named by its site"), (3, "named by its site")}


def test_a_page_is_read_once_for_all_places_on_it(spark):
    page, e = F.col("page"), F.col("e")
    df = spark.createDataFrame([("<p>Петров, директор a@b.ru и xa@b.ru <!-- директор a@b.ru --> Сбыт</p>" + "x" * 400 + "<a href='mailto:a@b.ru'>директор</a>", "A@b.ru")], "page string, e string")
    text_of = lambda c: df.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
    assert text_of(campaign.distance(page, e, F.lit("директор"))).count("mailto:") == 1
    for c in (campaign.is_printed(page, e), campaign.is_labelled(page, e, F.lit("сбыт"))):
        assert text_of(c).count("noscript") == text_of(F.length(campaign.html.visible(page))).count("noscript")
    assert text_of(campaign.is_on_page(page, e)).count("&nbsp;") == 1
    got = df.select(campaign.distance(page, e, F.lit("директор")), campaign.distance(page, e, F.lit("нет")), campaign.is_printed(page, e), campaign.is_labelled(page, e, F.lit("СБЫТ")), campaign.is_on_page(page, F.lit("b@b.ru"))).first()
    assert tuple(got) == (1, None, True, True, False)


def test_near_rows_meet_as_lists_that_are_dealt_out(spark):
    words = F.element_at(F.array(*map(F.lit, ["bolt", "bold", "boots", "nut", None])), (F.col("id") % 5 + 1).cast("int"))
    df = spark.range(600).select("id", words.alias("w"), F.when(F.col("id") % 7 < 5, F.col("id") % 2).alias("g"))
    df = df.unionByName(df.filter("id < 20"))  # numbers that repeat
    rows = df.collect()
    near = {("bolt", "bold"), ("bolt", "boots")}
    alike = lambda a, b: a is not None and b is not None and (a == b or (a, b) in near or (b, a) in near)
    wanted = sorted((x.id, y.id) for x in rows for y in rows if x.id < y.id and x.g is not None and x.g == y.g and alike(x.w, y.w))
    for size in (7, 1000):
        assert sorted(map(tuple, R.near_rows(df, "id", "w", 2, ["g"], size).collect())) == wanted
    plan = R.near_rows(df, "id", "w", 2, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(peers") < plan.index("Repartition") < plan.index("Join")  # pairs are made last, from lists dealt out


def test_a_quote_reads_its_content_once_and_every_item_that_is_asked_for(spark):
    from sitesieve import catalogue_more

    df = spark.createDataFrame([("one two; new words that are here and missing", "one two x here are words that now new and")], "q string, c string").select(facts.is_grounded(F.col("q"), F.col("c")).alias("g"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.index("array_distinct(") < plan.index("forall(")  # not again for each word of the quote
    assert df.first().g is True  # six of seven words
    tables = {"benchmark": spark.range(3000).select((2999 - F.col("id")).alias("item_id"), F.concat(F.lit("Item "), 2999 - F.col("id")).alias("text")), "documents": spark.range(80).select(F.col("id").alias("doc_id"), F.concat(F.lit("the item  "), F.col("id") % 40).alias("text"))}
    got = catalogue_more.grounded_quote(tables.get).collect()
    assert len(got) == 80 and all(r.grounded for r in got)


def test_words_of_names_are_judged_once_and_rows_are_dealt_out(spark, monkeypatch):
    from sitesieve import catalogue_more

    judged = []
    grammar, is_surname = people.Names(), people.Names.is_surname
    monkeypatch.setattr(people.Names, "is_surname", lambda self, w: (judged.append(w), is_surname(self, w))[1])
    monkeypatch.setattr(people, "_WORDS_KEPT", 8)
    found = {tuple(p for *_, p in grammar.find(f"Директор Иванов Пётр Ильич ({k}), Ольга Смирнова")) for k in range(500)}
    assert found == {(people.Person("Иванов", "Пётр", "Ильич"), people.Person("Смирнова", "Ольга"))} and len(judged) < 20
    [grammar.find(f"Слово{'а' * k}") for k in range(50)]
    assert len(grammar._kinds) <= 8
    customers = spark.range(100).select(F.col("id").alias("c_custkey")).coalesce(1)
    x = catalogue_more.name_and_title_spans(lambda name: customers)
    sizes = [len(p) for p in x.rdd.glom().collect()]
    assert len(sizes) > 1 and max(sizes) < 50
