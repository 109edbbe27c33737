"""Cases that small prose does not hold: texts built against hashes, clashing columns, long texts, lost files, rare
languages, noise about notices; and plain versions of the models' parts."""

import collections
import gzip
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
from sitesieve.llm import words as W


def thue_morse(n, first="a", second="b"):
    return "".join(first if i.bit_count() % 2 == 0 else second for i in range(n))


TWINS = thue_morse(4096), thue_morse(4096, "b", "a")
CLASH = ["_k", "_t", "_kept", "_hits", "_items", "_letter_of_text", "k", "t", "rest", "letter", "places", "copy", "f", "h"]


def multiset(df):
    return collections.Counter(map(tuple, df.collect()))


def test_xxh64_equals_the_library():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(4000))
    start = np.array([rng.randrange(3000) for _ in range(600)])
    end = start + np.array([rng.choice([0, 1, 3, 4, 7, 8, 15, 16, 31, 32, 33, 63, 64, 100, 256, 257, 900]) for _ in start])
    for seed in (0, 1, 42):
        got = W.xxh64(np.frombuffer(data, np.uint8), start, end, seed)
        assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(start, end)]


def test_twin_words_are_told_apart(spark):
    w = W.split(pa.array(TWINS))
    assert all(len(set(W.hashes(w, i).tolist())) == 2 for i in (0, 1))
    tail = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{TWINS[0]} {tail}"), (2, f"{TWINS[1]} {tail}")], "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.digest(docs).collect()} == {0}
    e = packing.Encoder(packing.tokenizer_path())
    for x in TWINS:
        assert e.encode(pa.array([x]), None)[0].tolist() == e.plain([x])[0]
    item = spark.createDataFrame([(1, f"{TWINS[0]} {tail}")], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.judged(docs, item).collect()} == {1: 20, 2: 19}
    model = kneser_ney.trained(docs.filter("doc_id = 1"))
    assert {r.doc_id: r.n_known for r in kneser_ney.scored(docs, model).collect()} == {1: 21, 2: 20}


def test_encoder_compares_bytes(monkeypatch):
    """All stretches of one length fall together: results must not change."""
    monkeypatch.setattr(W, "hashes", lambda words, which=0: (words.end - words.start).astype(np.uint64))
    e = packing.Encoder(packing.tokenizer_path())
    many = ["the cat sat on the mat", "one two three, four", "abc def ghi.", "", "the cat"]
    ids, first = e.encode(pa.array(many), None)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == e.plain(many)


def test_columns_of_any_name_pass_the_stages(spark, tmp_path):
    import corpus_pipeline as c

    bench = spark.createDataFrame([(1, "not in any document of this small table, not even the least part of it, at all")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, " ".join(f"{'abcdefg'[i % 7]}{j * (i + 1)}" for j in range(80)), "en" if i % 2 else "de", *range(len(CLASH))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{x} int" for x in CLASH))
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert multiset(out) == multiset(docs)
    assert decontaminate.clean(docs, bench, block_bytes=1).columns == docs.columns
    assert simhash.near_duplicates(docs).count() == substring_dedup.digest(docs).count() == license_scan.scanned(docs).count() == 30


def test_an_unlabelled_corpus_stays(spark):
    import corpus_pipeline as c

    docs = spark.createDataFrame([(1, "some words", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in c.language_id(spark, docs, "").collect()] == [1]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_hot_windows(spark):
    """A document repeated many times is one; a window of half of all texts leaves its first place alone."""
    common = " ".join(f"c{i}" for i in range(25))
    rows = [(i, f"{' '.join(f'u{i}x{j}' for j in range(i % 9))} {common}") for i in range(300)] + [(7, f"own {common}")] * 200 + [(None, "q " + common), (None, "r " + common)]
    got = substring_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    seen, wanted = set(), {}
    for i, x in sorted({(shared.NO_ID if i is None else i, x) for i, x in rows}, key=lambda r: (r[0], spark.range(1).select(F.xxhash64(F.lit(r[1]))).first()[0] if r[0] in (7, shared.NO_ID) else 0)):
        w, gone = x.split(), set()
        for p in range(len(w) - 19):
            if tuple(w[p : p + 20]) in seen:
                gone |= set(range(p, p + 20))
            seen.add(tuple(w[p : p + 20]))
        wanted[i, hashlib.sha256(" ".join(a for j, a in enumerate(w) if j not in gone).encode()).hexdigest()] = len(gone)
    assert {(shared.NO_ID if r.doc_id is None else r.doc_id, r.kept_sha256): r.n_removed for r in got} == wanted and len(got) == len(rows)


def test_lost_model_files_are_an_error(spark, tmp_path, monkeypatch):
    import os

    docs = spark.createDataFrame([(i, f"a b c d{i}") for i in range(40)], "doc_id long, text string")
    model = kneser_ney.trained(docs, model_dir=str(tmp_path), bucket_bytes=64)
    assert model.buckets > 3
    monkeypatch.setattr(kneser_ney, "OPEN", 2)
    m = kneser_ney.Mapped(model)
    assert m.sums(pa.array(["a b c d1"]))[1].tolist() == [5] and len(m.files) == 2
    for f in os.listdir(model.folder):
        os.remove(f"{model.folder}/{f}")
    with pytest.raises(Exception, match="No such file"):
        kneser_ney.scored(docs, model).collect()


def test_lists_stop_early():
    rng = np.random.default_rng(5)
    ids, vectors = np.arange(4000), rng.integers(-60, 60, (4000, 3))
    lists = topk.Lists(ids, vectors)
    for i in range(0, 4000, 400):
        q = vectors[i]
        got = list(zip(*(x.tolist() for x in lists.best(i, q, 5))))
        all_ = vectors @ q
        assert got == sorted(((j, int(all_[j])) for j in range(4000) if j != i), key=lambda x: (-x[1], x[0]))[:5]
    assert 0 < lists.scored < 10 * 4000 / 2  # under half of the candidates were ever scored
    assert topk.Lists(ids, vectors).best(-1, np.zeros(3, np.int64), 4)[0].tolist() == [0, 1, 2, 3]


def test_notices_by_brute_force(spark):
    rng = random.Random(9)
    notices, drift = license_scan.NOTICES, 6
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(1, 3)):
            n = rng.choice(notices)[0].split()
            for _ in range(rng.randint(0, 3)):
                j = rng.randrange(len(n))
                n = n[:j] + rng.choice([[], ["x"], ["x"] * 9]) + n[j + rng.randint(0, 1) :]
            words += n + ["public", "license"] * rng.randint(0, 4)
        texts.append(" ".join(words))
    texts.append(notices[5][0] + " public license x" * 40)

    def judged(x):
        w, labels, best = x.split(), set(), 0.0
        for phrase, label in notices:
            p = phrase.split()
            pairs = len(p) - 1
            votes = collections.defaultdict(set)
            for i in range(len(w) - 1):
                for j in range(pairs):
                    if w[i : i + 2] == p[j : j + 2]:
                        votes[i - j].add(j)
            for d in votes:
                met = set().union(*(votes.get(d + e, set()) for e in range(min(drift, (pairs + 1) // 2) + 1)))
                if len(met) / pairs >= 0.8:
                    labels.add(label)
                    best = max(best, len(met) / pairs)
        based = [label for phrase, label in license_scan.BASE if f" {phrase} " in f" {x} "]
        return ",".join(sorted(labels | set(based))), 1.0 if based else best

    got = license_scan.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: (r.labels, round(r.score, 9)) for r in got.collect()} == {i: (a, round(b, 9)) for i, x in enumerate(texts) for a, b in [judged(x)]}
    assert judged(texts[-1]) == ("mpl", 1.0)


def test_warc_files_there_and_back(spark, tmp_path):
    body = "<html lang=\"de\"><head><title>Ü</title></head><body><p>Größe <A class='x' HREF='/a'>a</A></p></body></html>".encode("latin-1")
    packed = gzip.compress(body)
    chunked = b"%x\r\n" % len(packed) + packed + b"\r\n0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    one = lambda kind, i, block: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nWARC-Target-URI: http://a.example/{i}\r\nWARC-Date: 2024-05-0{i}T00:00:00Z\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    data = [one("warcinfo", 1, b"software: x"), one("response", 2, http), one("request", 3, b"GET / HTTP/1.1"), one("response", 4, b"HTTP/1.1 404 No\r\n\r\n"), one("response", 5, http)[:-40]]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in data))
    (tmp_path / "b.warc").write_bytes(b"".join(data))
    given = warc.read(spark, str(tmp_path / "*.warc*"))
    assert sorted(r.response_id for r in given.collect()) == ["<urn:uuid:2>"] * 2 + ["<urn:uuid:4>"] * 2
    derived = warc.derived(given)
    manifest = warc.write(derived, str(tmp_path / "out")).collect()
    assert sum(r.records for r in manifest) == 8
    back = []
    for r in manifest:
        raw = open(r.file, "rb").read()
        assert len(raw) == r.bytes
        n, rest = 0, raw
        while rest:  # each member is one record
            d = zlib.decompressobj(31)
            assert d.decompress(rest).count(b"WARC/1.1\r\n") == 1
            n, rest = n + 1, d.unused_data
        assert n == r.records
        with gzip.open(r.file) as f:
            back += list(warc.records(f))
    meta = [(f, b.decode()) for f, b in back if f["warc-type"] == "metadata" and f["warc-refers-to"] == "<urn:uuid:2>"]
    assert len(meta) == 2 and meta[0] == meta[1]
    fields, block = meta[0]
    assert "title: Ü\r\nlanguage: de\r\nlinks: 1\r\n" in block and "\r\nhttp-status: HTTP/1.1 200 OK\r\nhttp-Content-Type: text/html" in block
    assert fields["x-refers-to-payload-digest"] == "sha256:" + hashlib.sha256(body).hexdigest() and fields["warc-date"] == "2024-05-02T00:00:00Z"
    assert fields["warc-block-digest"] == "sha256:" + hashlib.sha256(block.encode()).hexdigest()
    assert any(b.decode() == "Größe a" for f, b in back if f["warc-type"] == "conversion")


def test_forward_backward_by_the_plain_sum():
    rng = np.random.default_rng(2)
    for n, k in ((1, 2), (7, 3), (150, 2), (70, 4)):
        e, t = rng.normal(size=(n, k)) * 2, rng.normal(size=(k, k))
        fresh = rng.random(n) < 0.1
        fresh[0] = True
        got, joint = language.posteriors(e, fresh, t, block=16, with_joint=True)
        wanted, pairs = np.zeros((n, k)), np.zeros((k, k))
        cuts = [*np.flatnonzero(fresh), n]
        for a, b in zip(cuts, cuts[1:]):
            f, g = np.zeros((b - a, k)), np.zeros((b - a, k))
            f[0] = np.exp(e[a])
            for i in range(a + 1, b):
                f[i - a] = np.exp(e[i]) * (f[i - a - 1] @ np.exp(t))
                f[i - a] /= f[i - a].sum()
            g[-1] = 1
            for i in range(b - 2, a - 1, -1):
                g[i - a] = np.exp(t) @ (np.exp(e[i + 1]) * g[i - a + 1])
                g[i - a] /= g[i - a].sum()
            p = f * g
            wanted[a:b] = p / p.sum(1, keepdims=True)
            for i in range(a, b - 1):
                x = f[i - a][:, None] * np.exp(t) * (np.exp(e[i + 1]) * g[i - a + 1])[None]
                pairs += x / x.sum()
        assert np.allclose(got, wanted, atol=1e-9) and np.allclose(joint, pairs, atol=1e-7)


def test_language_query_by_the_plain_version():
    model = language.fit(["the house is on the hill"] * 5 + ["der hund ist im garten"] * 5, ["en"] * 5 + ["de"] * 5, rounds=10)
    texts = ["the house 12 der hund", "garten", "on the hill is der hund im garten"]
    pred, score = language.Tagger(model).judged(pa.array(texts), pa.array([True] * 3))
    for x, p, s in zip(texts, pred.to_pylist(), score.to_pylist()):
        total = np.zeros(2)
        w, h, lettered = language._words(pa.array([x]))
        e = []
        for i in range(len(h)):
            f = language.features(w.buf, w.start[i : i + 1], w.end[i : i + 1], h[i : i + 1])
            e.append(model.weights[f.number].sum(0) / math.sqrt(len(f.number)) if lettered[i] else np.zeros(2))
        e = np.array(e, np.float32).astype(float)
        for path in np.ndindex(*[2] * len(h)):
            weight = math.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(model.transition[a, b] for a, b in zip(path, path[1:])))
            total += weight * np.bincount(path, minlength=2)
        share = total / total.sum()
        assert p == model.langs[int(share.argmax())] and abs(s - share.max()) < 1e-5


def test_a_rare_language_is_sampled(spark):
    rows = [(i, f"the house is on hill {i}", "en") for i in range(2000)] + [(i, f"der hund ist im garten {i}", "de") for i in range(5000, 5008)]
    rows += [(6000, "ein " * 40000, "xx")]  # longer than train_bytes
    model = language.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_docs=20)
    assert model.langs == ["de", "en"]


def test_statistics_by_the_plain_version():
    rng = random.Random(4)
    texts = ["", "One two, two. THREE!\n\nfour é 12", "x", "\n", *(" ".join(rng.choices(["a", "Bcd", "e,", "12", "ß", "verylongwordindeed", "z.\n"], k=40)) for _ in range(6))]
    got = quality.statistics(pa.array(texts))
    for x, row in zip(texts, got):
        b, words, lines = x.encode(), re.findall(rb"[^ \t-\r]+", x.encode()), [y for y in x.encode().split(b"\n") if y]
        n, m = max(len(b), 1), max(len(words), 1)
        sizes = [len(w) for w in words]
        top = lambda v: max(collections.Counter(v).values(), default=0)
        entropy = lambda v: -sum(c / len(v) * math.log(c / len(v)) for c in collections.Counter(v).values()) if v else 0.0
        pairs = list(zip(words, words[1:]))
        share = lambda kind: sum(chr(y) in kind for y in b) / n
        letters = "abcdefghijklmnopqrstuvwxyz"
        wanted = {
            "log_bytes": math.log1p(len(b)), "log_words": math.log1p(len(words)), "mean_word": sum(sizes) / m, "word_spread": np.std(sizes) if sizes else 0.0,
            "letters": share(letters + letters.upper()), "upper": share(letters.upper()), "digits": share("0123456789"), "stops": share(".!?"), "commas": share(",;:"),
            "lines_per_word": len(lines) / m, "wide": sum(y >= 128 for y in b) / n, "distinct_words": len(set(words)) / m, "top_word": top(words) / m,
            "repeated_pairs": sum(c for c in collections.Counter(pairs).values() if c > 1) / m, "top_pair": top(pairs) / m, "word_entropy": entropy(words), "byte_entropy": entropy(list(b)),
            "mean_line": len(b) / max(len(lines), 1), "distinct_lines": len(set(lines)) / max(len(lines), 1), "long_words": sum(s > 15 for s in sizes) / m, "short_words": sum(s < 4 for s in sizes) / m,
            "capital_words": sum(65 <= w[0] <= 90 for w in words) / m, "sentence_words": len(words) / max(1, sum(y in b".!?" for y in b)),
        }
        for name, value in wanted.items():
            assert abs(row[quality.NAMES.index(name)] - value) < 1e-6, (x, name)


def test_trees_by_the_plain_walk_and_quality_query(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(400, 4)), rng.integers(0, 2, 400).astype(float)
    t = quality.fit(x, y, trees=9, depth=3)

    def walk(row):
        total = t.base
        for node in t.roots:
            while t.left[node] != node:
                node = t.left[node] if row[t.feature[node]] <= t.threshold[node] else t.right[node]
            total += t.value[node]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(t.score(x), [walk(r) for r in x])
    good, bad = "A plain sentence, with words. And another one follows it.", "$$$ CLICK >>> 111 111 111 ### !!!"
    docs = spark.createDataFrame([(i, f"{good} {i}" if i % 2 else f"{bad} {i}") for i in range(300)] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    got = quality.scored(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got if r.doc_id < 300)
    again = quality.scored(docs, labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert multiset(again) == multiset(quality.scored(docs, labels))  # held-out labels change nothing


def test_long_texts(spark, tmp_path):
    rng = random.Random(3)
    long = " ".join(rng.choices([f"word{i}" for i in range(3000)], k=400_000))
    one = "x" * 300_000 + " y"
    docs = spark.createDataFrame([(1, long, "en"), (2, one, "en"), (3, "ein kurzer text im garten", "de"), (4, "the end of it", "en")], "doc_id long, text string, lang string")
    n = {1: 400_000, 2: 2, 3: 5, 4: 4}
    assert {r.doc_id: r.n_words for r in substring_dedup.digest(docs).collect()} == n
    assert {r.doc_id: r.n_tokens for r in kneser_ney.scored(docs, kneser_ney.trained(docs)).collect()} == {i: x + 1 for i, x in n.items()}
    item = spark.createDataFrame([(1, " ".join(long.split()[-30:]))], "item_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.judged(docs, item).collect()} == {i: (x, 30 if i == 1 else 0) for i, x in n.items()}
    assert {r.doc_id: r.n_words for r in license_scan.scanned(docs).collect()} == n
    assert simhash.near_duplicates(docs).count() == quality.scored(docs, docs.selectExpr("doc_id", "1 as quality")).count() == 4
    assert {r.doc_id: r.lang_pred for r in language.identified(docs, language.trained(docs)).collect()}[3] in ("de", "en")
    pieces = packing.packed(docs, packing.tokenizer_path()).groupBy("doc_id").agg(F.sum("length").alias("a"), F.first("doc_tokens").alias("b")).collect()
    assert len(pieces) == 4 and all(r.a == r.b for r in pieces)
    pages = spark.createDataFrame([(1, "u", f"<p>{long}</p>")], "page_id long, url string, html string")
    assert {len(r.block) for r in warc.derived(warc.responses(pages)).filter("warc_type = 'conversion'").collect()} == {len(long)}
    wide = spark.createDataFrame([(i, [1.0] * (5000 if i == 7 else 3)) for i in range(40)], "vec_id long, embedding array<double>")
    rows = topk.scaled(wide)
    assert topk.search(rows.filter("vec_id % 20 = 0"), rows, 5).count() == 10
