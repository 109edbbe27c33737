"""The training-data operators against plain versions, and over nulls, empties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sitesieve.llm import decontaminate, kneser_ney, language, license_scan, packing, quality, shared, simhash, substring_dedup, topk, warc

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, t int, h long, f long, label string, places string"


def low(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def texts():
    rng = random.Random(5)
    words = {x: [x + str(i) + rng.choice(["", ",", ".", "é", "日"]) for i in range(60)] for x in ("en", "fr")}
    passage = " ".join(rng.choices(words["en"], k=60))
    out = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        body = " ".join(rng.choices(words[lang], k=rng.choice([3, 19, 20, 40, 200])))
        out.append((i, body + (" " + passage if i % 4 == 0 else ""), lang))
    out += [(100 + i, out[7][1], "en") for i in range(8)] + [(110, out[9][1] + " Extra", "fr"), (111, out[9][1], "fr")]
    out += [(200, None, "en"), (201, "", "en"), (202, " \n\t ", None), (203, "12 34 !!", "en"), (204, passage * 30, "en"), (205, "Released under the MIT License. GNU General Public License, cc by", None)]
    out += [out[3], out[3], (None, "a null id " + passage, "fr")]
    return out


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, x, g, "src", len(x or ""), 1, 2, 3, 4, "x", "y") for i, x, g in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(df):
    return collections.Counter(map(tuple, df.collect()))


def test_substring_dedup(docs, rows, none):
    seen, wanted = set(), {}
    for i, x in sorted({(shared.NO_ID if i is None else i, x or "") for i, x, _ in rows}):
        w = SPACED.findall(x)
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if tuple(w[p : p + 20]) in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(tuple(w[p : p + 20]))
        kept = " ".join(a for a, g in zip(w, gone) if not g)
        wanted[None if i == shared.NO_ID else i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    for start in (5, 10, 20):
        assert multiset(substring_dedup.digest(docs, 20, start)) == collections.Counter((i, *wanted[i]) for i, _, _ in rows)
    out = substring_dedup.rewritten(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    for r in out.collect():
        assert len(SPACED.findall(r.text or "")) == wanted[r.doc_id][0] - wanted[r.doc_id][1]
    assert substring_dedup.digest(none).count() == 0


def test_simhash(docs, rows, none):
    prints = {}
    for i, x, _ in rows:
        w = SPACED.findall(low(x))
        h = [xxhash.xxh64_intdigest(" ".join(w[j : j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
    ids = sorted(prints, key=lambda i: -1 if i is None else i)
    part = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    part[b] = min(part[a], part[b], key=ids.index)
    assert multiset(simhash.near_duplicates(docs)) == collections.Counter((i, f"{prints[i]:016x}", part[i]) for i, _, _ in rows)
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == 500


def test_decontaminate(spark, docs, rows, none):
    items = [(1, " ".join(rows[0][1].split()[-20:])), (2, "MIT license"), (3, None), (4, ""), (11, " ".join(rows[4][1].split()[:13]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, x in items:
        w = PLAIN.findall(low(x))
        for p in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + min(13, len(w))]), set()).add(str(i))

    def judged(x):
        w, hit, met = PLAIN.findall(low(x)), set(), set()
        for size in {len(k) for k in windows}:
            for p in range(len(w) - size + 1):
                if found := windows.get(tuple(w[p : p + size])):
                    met |= found
                    hit |= set(range(p, p + size))
        return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)

    wanted = collections.Counter((i, *judged(x)) for i, x, _ in rows)
    assert any(k[-1] for k in wanted)
    assert multiset(decontaminate.judged(docs, bench)) == wanted
    assert multiset(decontaminate.judged(docs, bench, block_bytes=50)) == wanted
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in wanted.items() if not k[-1])
    assert decontaminate.judged(none, bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


def test_packing(docs, rows, none):
    path = packing.tokenizer_path()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    got = packing.packed(docs, path, most=64, with_ids=True).collect()
    assert len({r.sequence_id for r in got}) == len(got) and all(r.length & (r.length - 1) == 0 and r.offset == 0 for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, x, _ in {(i, x, 0) for i, x, _ in rows}:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        copies = sum(1 for r in rows if r[0] == i)
        assert sum(r.length for r in by[i]) == copies * len(ids)
        for r in by[i]:
            piece = ids[r.start : r.start + r.length]
            assert r.ids == piece and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes()) and r.doc_tokens == len(ids)
    assert packing.packed(none, path).count() == 0


def test_encoder_equals_the_tokenizer():
    rng = random.Random(1)
    parts = ["a", "Z", "é", "×", "÷", " ", "  ", "\n", "\t", " ", "　", ".", "'s", "'", ",", "1", "日", "!", "<|endoftext|>", "\x1c", "ß", "€", "\r\n", " t"]
    many = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    e = packing.Encoder(packing.tokenizer_path(), most=100)
    for a in range(0, len(many), 500):
        ids, first = e.encode(pa.array(many[a : a + 500]), None)
        assert [ids[x:y].tolist() for x, y in zip(first, first[1:])] == e.plain(many[a : a + 500])


def test_kneser_ney(docs, rows, none):
    train = docs.filter(shared.fold_of("doc_id") != 1)
    model = kneser_ney.trained(train, bucket_bytes=4000)
    tokens = [[*SPACED.findall(low(x)), None] for _, x, _ in rows]
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 for i, _, _ in rows]
    c, pairs = collections.Counter(), collections.Counter()
    for w, k in zip(tokens, fold):
        if k != 1:
            c.update(w)
            pairs.update(zip(["<s>", *w], w))
    n, v = sum(c.values()), len(c)
    follows, context = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (u, w), k in pairs.items():
        follows[w] += 1
        context[u][0] += k
        context[u][min(k, 3)] += 1
    classes = lambda x: [sum(y == k for y in x) for k in (1, 2, 3, 4)]
    d, e, all_ = kneser_ney.discounts(*classes(pairs.values())), kneser_ney.discounts(*classes(follows.values())), sum(follows.values())
    gamma = sum(e[min(x, 3)] for x in follows.values()) / all_

    def p(u, w):
        one = max(follows[w] - e[min(follows[w], 3)], 0) / all_ + gamma / (v + 1)
        if u not in context:
            return one
        total, *ones = context[u]
        k = pairs[u, w]
        return max(k - d[min(k, 3)], 0) / total + sum(a * b for a, b in zip(d[1:], ones)) / total * one

    wanted = sorted((len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6), round(sum(math.log10(p(u, x)) for u, x in zip(["<s>", *w], w)), 6)) for w in tokens)
    got = kneser_ney.scored(docs, model)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect()) == wanted
    empty = kneser_ney.trained(none)
    assert all(r.score == 0 and r.n_known == 0 for r in kneser_ney.scored(docs, empty).collect())
    assert kneser_ney.scored(none, empty).count() == 0


def test_license_scan(docs, rows, none):
    def judged(x):
        w = PLAIN.findall(low(x))
        at = [(p, label) for phrase, label in license_scan.BASE for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        return len(w), len(at), min((a for a, _ in at), default=None), max((a for a, _ in at), default=None), ",".join(sorted({b for _, b in at}))

    got = license_scan.scanned(docs)
    assert multiset(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == collections.Counter((i, *judged(x)) for i, x, _ in rows)
    assert license_scan.scanned(none).count() == 0


def test_notices_with_changed_words(spark):
    notice = license_scan.NOTICES[0][0].split()
    near, far = notice[:5] + ["really"] + notice[5:], notice[:4] + ["x"] * 20 + notice[12:]
    df = spark.createDataFrame([(1, " ".join(near)), (2, " ".join(far)), (3, "All rights reserved.")], "doc_id long, text string")
    got = {r.doc_id: (r.base_labels, r.labels) for r in license_scan.scanned(df).collect()}
    assert got == {1: ("", "mit"), 2: ("", ""), 3: ("", "")}


def test_language(docs, none, rows):
    model = language.trained(docs)
    got = language.identified(docs, model).collect()
    by = {i: x for i, x, _ in rows}
    lang = {i: g for i, _, g in rows}
    assert len(got) == len(rows)
    for r in got:
        if not re.search(r"[^\W\d_]", by[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif lang[r.doc_id] and r.doc_id is not None and r.doc_id % 4:  # every fourth has a passage of the other language
            assert r.lang_pred == lang[r.doc_id]
    assert language.identified(none, model).count() == 0
    assert {r.lang_pred for r in language.identified(docs, language.trained(none)).collect()} == {"und"}


def test_code_switched_words():
    model = language.fit(["the house is on the hill and the sea"] * 6 + ["der hund ist im garten und schläft"] * 6, ["en"] * 6 + ["de"] * 6, rounds=20)
    _, p = language.Tagger(model).tagged(pa.array(["the house is on the hill der hund ist im garten und schläft"]))
    assert [model.langs[j] for j in p.argmax(1)] == ["en"] * 6 + ["de"] * 7


def test_quality(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, int((i or 0) % 3 > 0), None) for i in range(120)] + [(5, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(none, labels).count() == 0


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < 0)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


def test_topk(spark):
    rng = random.Random(3)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)] + [(300 + i, [0.5] * 6) for i in range(60)]
    bad = [(400, None), (420, [1.0, None]), (440, [float("nan")]), (460, []), (None, [1.0]), (461, [float("inf")])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>")
    v = {i: [math.floor(64 * a) for a in x] for i, x in vectors}
    wanted = set()
    for q in (i for i in v if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in v if i != q)[:7]
        wanted |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    rows = topk.scaled(df)
    assert set(map(tuple, topk.search(rows.filter("vec_id % 20 = 0"), rows, 7, block=64).collect())) == wanted
    assert topk.search(rows.limit(0), rows).count() == 0


def test_warc(spark):
    page = "<html lang=\"en\"><head><title>T &amp; x</title></head><body><p>One<br>two<script>no</script> &lt;b&gt;</p></body></html>"
    df = spark.createDataFrame([(1, "http://a.example/", page, 9), (2, None, None, 9)], "page_id long, url string, html string, block int")
    got = {(r.page_id, r.warc_type): r for r in warc.serialized(warc.derived(warc.responses(df))).collect()}
    text = got[1, "conversion"]
    assert text.block == "One\ntwo <b>" and text.block_digest == "sha256:" + hashlib.sha256(text.block.encode()).hexdigest()
    assert text.refers_to == got[1, "metadata"].refers_to != got[2, "metadata"].refers_to
    assert "title: T & x\r\nlanguage: en" in got[1, "metadata"].block and got[2, "conversion"].block == ""
    assert "\r\nhttp-status: HTTP/1.1 200 OK\r\nhttp-Content-Type: text/html" in got[1, "metadata"].block
    head, _, body = bytes(text.record).partition(b"\r\n\r\n")
    assert f"Content-Length: {len(text.block.encode())}".encode() in head and body == text.block.encode() + b"\r\n\r\n"
    assert warc.derived(warc.responses(df.limit(0))).count() == 0


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    import corpus_pipeline as c

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this occurs in any document at all, as far as anyone can tell")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [given.count()]
    for _, stage in c.STAGES[:-1]:
        given = stage(spark, given, str(tmp_path)).cache()
        assert given.columns == docs.columns
        kept.append(given.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 30
    assert given.groupBy("doc_id").count().filter("count > 1").count() == 0
    tokens = c.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("a"), F.first("doc_tokens").alias("b"))
    assert tokens.filter("a <> b").count() == 0


def test_pipeline_near_dedup_keeps_one_of_each_group(spark, docs):
    import corpus_pipeline as c

    body = " ".join(f"w{i}" for i in range(3000))
    rows = [(7, body, 1), (5, body, 2), (9, body + " more", 3), (5, body, 4), (None, "alone, without an id", 5), (None, "alone, without an id", 6), (11, "quite another text of few words", 7), (12, None, 8), (13, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _score int")
    kept = c.near_dedup(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 5, 11, 12]
    assert c.near_dedup(spark, df.limit(0), "").count() == 0


def test_memory_is_given_back_after_the_last_batch():
    from sitesieve.llm import words

    assert list(words.released(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3]
    words.give_back()


def test_pipeline_near_dedup_keeps_null_ids_and_texts_of_one_id(spark):
    import corpus_pipeline as c

    text = [" ".join(f"{x}{i}" for i in range(300)) for x in "abcdef"]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, text[2]), (4, text[2]), (8, text[3]), (8, text[4]), (3, text[4]), (9, text[3]), (8, text[3]), (10, text[5])]
    kept = c.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert multiset(kept) == collections.Counter([(None, text[0]), (None, text[1]), (None, text[2]), (8, text[3]), (3, text[4]), (10, text[5])])


def test_language_learns_beside_a_repeated_id(spark):
    en, de = "the house is on the hill and the sea", "der hund ist im garten und schläft"
    hot = min((i for i in range(200) if zlib.crc32(str(i).encode()) % 5), key=lambda i: spark.range(1).select(F.xxhash64(F.lit(i).cast("bigint"), F.lit(11))).first()[0])
    rows = [(hot, en, "en")] * 50 + [(hot, f"{en} {i}", "en") for i in range(50)] + [(i, f"{de} {i}", "de") for i in range(200, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, fit = [], language.fit
    language.fit = lambda texts, langs: seen.append((texts, langs)) or fit(texts, langs)
    try:
        model = language.trained(df, train_docs=40)
    finally:
        language.fit = fit
    texts, langs = seen[0]
    assert model.langs == ["de", "en"] and len(texts) == len(set(texts)) == len(langs) == 40


def test_warc_decodes_all_references(spark):
    import html

    names = [f"&{x}" for x in html.entities.html5] + ["&#8217;", "&#x2019;", "&#128;", "&#0;", "&#xD800;", "&amp;lt;", "&notit;", "&unknown;", "&;", "& x", "AT&T"]
    text = "|".join(x for x in names if "\n" not in html.unescape(x))
    page = f"<head><title>caf&eacute; &#8217;&#13;&#10;x: &amp;amp;</title></head><body><p>{text}</p><p>a&nbsp;b&#160;c &middot; d</p></body>"
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = {r.warc_type: r.block for r in warc.derived(warc.responses(df)).collect()}
    assert got["conversion"] == html.unescape(text).replace("\xa0", " ") + "\na b c · d"
    assert got["metadata"].startswith("title: café ’ x: &amp;\r\nlanguage: ")
