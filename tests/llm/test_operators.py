"""Every operator on small awkward tables, and against brute force where SQL cannot say what is right."""

import base64
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderwell.llm import byte_bpe, decontaminate, exact_topk, html_text, near_duplicates, pii, secrets
from orderwell.llm import components, token_counts, toxicity, url_filter

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, label string"


def some_text(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgé", k=rng.randint(2, 7))) for _ in range(n))


BENCH = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
TEXTS = [
    (1, some_text(60, 1)), (2, some_text(60, 1) + " more"), (2, some_text(60, 1) + " more"), (3, None), (4, ""), (5, "!?"),
    (6, "mail joe.x@mail.example.com or +1 (988) 555-2485, ip 10.20.30.40 card 4041894974608795 end"),
    (7, f"start, {BENCH}. The end"), (None, some_text(30, 2)), (8, some_text(30_000, 3)), (9, 'token = "abcdef123456"'),
    (10, "  two  spaces\n\nand\ttabs "), (11, "a" * 50_000), (12, "AKIA" + "Z" * 16 + " " + "0f" * 20),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", None, "x", "y") for i, t in TEXTS], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_tokenizers_agree_with_the_libraries(docs, empty):
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN).collect()
    want = sorted((t or "", own.encode_ordinary(t or "")) for _, t in TEXTS)
    assert sorted((bytes(r.decoded).decode(), list(r.ids)) for r in got) == want
    assert byte_bpe.production(empty).count() == 0
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, path).collect())
    want = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for _, t in TEXTS]
    assert got == sorted(want) and token_counts.token_counts(empty, path).count() == 0


def test_base_spans_equal_the_expressions():
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = {
        "email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    rng = random.Random(5)
    parts = ["a@b.cc", "@", ".", "x_y", "1.2.3.4", "4041894974608795", "+1 (988) 555-2485", " ", "-", "7", "300.1.1.1", "é", "a@b"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=12))
        want = [(m.start(), m.end(), k) for k, p in kinds for m in re.finditer(p, text) if good[k](m[0])]
        assert pii.base_spans(text) == want


def test_personal_data_and_terms(spark, docs, empty):
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert [s.kind for s in found[6].base] == list(pii.KINDS[:1]) + ["ip", "card", "phone"] and not found[3].base
    assert pii.find_personal_data(empty).count() == 0
    told = [(i, f"{some_text(4, i)} zork{i} nickname xq@y.zz {some_text(4, 90 + i)}") for i in range(4)]
    rows = spark.createDataFrame(told + [(i, some_text(30, i)) for i in range(10, 200)], "doc_id long, text string")
    terms = {r.doc_id: [s for s in r.terms] for r in pii.find_personal_data(rows).where("size(terms) > 0").collect()}
    assert set(terms) == {0, 1, 2, 3} and all("nickname" in told[i][1][s.start : s.end] for i in terms for s in terms[i])
    clean = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[6].text and clean[6].n_chars == len(clean[6].text) and clean[7].text.startswith("start")
    assert pii.sanitise(docs).columns == docs.columns


def test_terms_of_a_fixed_block_and_of_rare_entities(spark):
    block = "Zork Plume, zp@y.zz"
    rows = [(i, f"{some_text(40, 500 + i)} {block} {some_text(40, 900 + i)}") for i in range(12)]
    copied = some_text(60, 77) + " quimby kk@y.zz"  # near copies of one text: a group that counts once
    rows += [(50 + i, f"{copied} {i}") for i in range(6)] + [(60, some_text(40, 61) + " twice tw@y.zz"), (61, "twice tw@y.zz " + some_text(40, 62))]
    rows += [(i, some_text(30, i)) for i in range(1000, 2200)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    scanned = pii.materialize(pii.scan(texts))
    found = {(r.entity, r.term) for r in pii.disclosing_pairs(texts, scanned).collect()}
    assert {("email:zp@y.zz", "zork"), ("email:zp@y.zz", "plume"), ("email:tw@y.zz", "twice")} <= found
    assert not any(e == "email:kk@y.zz" for e, _ in found)


def test_disclosing_terms_are_found_wherever_they_stand(spark):
    told = [(i, f"{some_text(40, 500 + i)} zork zp@y.zz {some_text(40, 900 + i)} Zork") for i in range(40)]
    told += [(50, some_text(30, 50) + " ZORK. zork@a.bc"), (None, "zork " + some_text(30, 51))]
    texts = told + [(i, some_text(30, i)) for i in range(1000, 1200)]
    rows = pii.find_personal_data(spark.createDataFrame(texts, "doc_id long, text string")).where("size(terms) > 0").collect()
    got = {r.doc_id: {dict(told)[r.doc_id][s.start : s.end].lower() for s in r.terms} for r in rows}
    assert set(got) == {*range(40), 50, None} and all(words == {"zork"} for words in got.values())
    assert {r.doc_id: len(r.terms) for r in rows} == {**{i: 2 for i in range(40)}, 50: 1, None: 1}


def test_secrets_equal_the_expressions(docs, empty):
    body = "A" * 30
    token = "ghp_" + body + secrets.registry_checksum(body)
    assert [s[2] for s in secrets.Scanner().scan(f"x {token} y")] == ["registry"]
    assert not secrets.Scanner().scan(f"x {token[:-1]}_ y")
    kinds = (("assign", re.compile(secrets.ASSIGN.pattern, re.A | re.I), lambda m: len(m[1]) >= 6),
             ("access", secrets.ACCESS, lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    rng = random.Random(6)
    parts = ["Password", "token", "TOKEN", "api_key", '"', " ", "=", ":", "abcdef", "secret=", "AKIA", "Z" * 9, "0f" * 12, "é", "'"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=14))
        want = [(m.start(), m.end(), k) for k, p, ok in kinds for m in p.finditer(text) if ok(m)]
        got = [s for s in secrets.Scanner().scan(text) if s[2] in secrets.BASE_KINDS]
        assert got == sorted(want, key=lambda s: (s[0], secrets.KINDS.index(s[2])))
    assert secrets.find_secrets(docs).count() == len(TEXTS) and secrets.find_secrets(empty).count() == 0


def test_added_kinds_equal_plain_searches():
    """Checked tokens, web tokens and key blocks, against expressions tried at every place of random texts."""
    head = base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode().rstrip("=")
    token = "ghp_" + "A" * 30 + secrets.registry_checksum("A" * 30)
    parts = [head, "eyJ", ".", "ab", " ", "-", "npm_", token, "ghp_", "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----",
             "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "-----BEGIN CERT-----", "é", "\n"]
    web = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
    key = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----.*?-----END \1-----", re.DOTALL)
    kinds = (("registry", secrets.REGISTRY, lambda m: secrets.registry_checksum(m[1]) == m[2]),
             ("webtoken", web, lambda m: secrets._is_web_token(m[1])), ("private_key", key, lambda m: True))
    rng, seen = random.Random(16), set()
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=12))
        want = [(m.start(), m.end(), k) for k, p, ok in kinds for m in p.finditer(text) if ok(m)]
        got = [s for s in secrets.Scanner().scan(text) if s[2] not in secrets.BASE_KINDS]
        assert got == sorted(want, key=lambda s: (s[0], secrets.KINDS.index(s[2]))), text
        seen |= {s[2] for s in got}
    assert seen == {"registry", "webtoken", "private_key"}


def test_long_texts_are_scanned_in_linear_time():
    n = 1 << 20
    labels = "".join(f"-----BEGIN A{i} PRIVATE KEY-----" for i in range(n // 32))
    for text in ("eyJ" * (n // 3), "eyJa." * (n // 5), "eyJa.b " * (n // 7), "-----BEGIN PRIVATE KEY-----" * (n // 27), labels, "token" * (n // 5),
                 "token=" * (n // 6), "token " * (n // 6), "AKIA" * (n // 4), "ghp_" * (n // 4), "token=" + " " * n):
        start = time.perf_counter()
        secrets.Scanner().scan(text)
        assert time.perf_counter() - start < 15, text[:20]
    for text in ("ab@c.de " * (n // 8), "1.2.3.4 " * (n // 8), "1.2.3.4, " + "-" * n, "+1 (988) 555-2485;" * (n // 18), "1.2.3.4.", "é@" * (n // 2),
                 ". 1.2.3.4," * 10_000 + "." * n, "x" * n + " 1.2.3.4 " + "y" * n, "a@b.c" * (n // 5)):
        start = time.perf_counter()
        pii.terms_near(text, pii.base_spans(text))
        assert time.perf_counter() - start < 15, text[:20]


def test_words_near_a_span_equal_a_plain_search():
    def plain(text, spans):
        out = []
        for start, end, kind in spans:
            near = [*pii.WORD.finditer(text, 0, start)][-pii.WINDOW :] + [*pii.WORD.finditer(text, end)][: pii.WINDOW]
            near = [m for m in near if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
            out += [(pii.entity_of(kind, text[start:end]), m.start(), m.end(), m[0].encode().translate(pii.FOLD).decode()) for m in near]
        return out

    rng, seen = random.Random(17), 0
    parts = ["a@b.cc", "1.2.3.4", "4041894974608795", "+1 (988) 555-2485", " ", ", ", " Word ", "é", " x", "7", "...", " one two three four five"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(1, 16)))
        spans = pii.base_spans(text)
        want = plain(text, spans)
        assert pii.terms_near(text, spans) == want, text
        seen += len(want)
    assert seen > 5000


def test_benchmark_passages(spark, docs, empty):
    bench = spark.createDataFrame([(1, BENCH), (1, BENCH), (2, None), (None, "two spaces")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.digest(decontaminate.find_benchmark(docs, bench)).collect()}
    assert (rows[7].n_hit, rows[7].n_items, rows[10].n_hit, rows[8].n_hit, rows[3].n_words) == (12, 1, 2, 0, 0)
    cut = {r.doc_id: r.text for r in decontaminate.remove_benchmark(docs, bench).collect()}
    assert cut[7] == "start, . The end" and cut[3] is None and cut[4] == ""
    assert decontaminate.find_benchmark(empty, bench).count() == 0
    assert decontaminate.find_benchmark(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    items = [(i, " ".join(rng.choice(list("abc"), 12))) for i in range(6)] + [(9, "c b")]
    phrases = decontaminate.Phrases(items)
    texts = [" ".join(rng.choice(list("abcd"), 400, p=[0.33, 0.33, 0.33, 0.01])) for _ in range(5)]
    for text, (_, spans, _) in zip(texts, decontaminate.search_texts(texts, phrases), strict=True):
        listed, hit = text.split(), set()
        for _, item in items:
            ws = item.split()
            for i in range(max(1, len(ws) - 9)):
                p = ws[i : i + 10]
                hit |= {k + d for k in range(len(listed)) if listed[k : k + len(p)] == p for d in range(len(p))}
        assert {k for a, b in spans for k in range(a, b)} == hit


def test_toxic_texts_are_learnt(spark, docs, empty):
    rows = [(i, some_text(20, i) + (" filthword" if i % 3 == 0 else "") + " tail") for i in range(300)]
    labelled = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(texts, labelled).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in held) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(docs, labelled.limit(0)).where("score = 0.5").count() == len(TEXTS)
    assert toxicity.toxicity(empty, labelled).count() == 0
    assert toxicity.reject_toxic(docs, labelled).columns == docs.columns


def test_training_sees_an_id_once(spark):
    rows = [(i % 7, some_text(20, i % 9)) for i in range(200)] + [(1, some_text(20, 1))] * 300 + [(None, "x"), (8, None), (9, "unlabelled")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    chosen = spark.createDataFrame([(i, i % 2) for i in (*range(7), 8)], "doc_id long, label int")
    got = toxicity.training_rows(texts, chosen).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(i, i % 2) for i in (*range(7), 8)]
    labels = chosen.withColumnRenamed("label", "toxic")
    once = texts.withColumn("h", F.xxhash64("text")).groupBy("doc_id").agg(F.min_by("text", "h").alias("text"))
    assert np.array_equal(toxicity.fit(texts, labels), toxicity.fit(once, labels))
    assert np.array_equal(toxicity.fit(texts, labels, most=3), toxicity.fit(once, labels, most=3))


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    rng = random.Random(7)
    base = some_text(80, 4).split()
    rows = []
    for i in range(60):  # a group that spreads beyond the reach of any one member
        ws = list(base)
        for _ in range(rng.randint(0, 6)):
            ws[rng.randrange(len(ws))] = f"w{rng.random()}"
        rows.append((i, " ".join(ws)))
    rows += [(100 + i, some_text(40, 100 + i // 2)) for i in range(20)]
    sets = [near_duplicates.shingles(near_duplicates.words(t), near_duplicates.WordHash()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            d = near_duplicates.weighted_distance(
                sets[a][0], near_duplicates.weights(sets[a][1]), sets[b][0], near_duplicates.weights(sets[b][1])
            )
            if min(d, near_duplicates.plain_distance(sets[a][0], sets[b][0])) <= 0.2 + 1e-9:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    classes = near_duplicates.near_duplicates(docs).collect()
    assert len(classes) == len(TEXTS) and {r.class_id for r in classes if r.doc_id in (1, 2)} == {1}
    assert {r.class_id for r in classes if r.doc_id in (3, 4)} == {3}
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 3
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_repeated_blocks_and_null_ids_are_linked(spark):
    rows = []
    for k in range(12):  # 100 shingles, and the same with a block of 25 words repeated; plain Jaccard similarity 0.8 or more
        base, block = some_text(104, 3000 + k), some_text(20, 4000 + k)
        ids = (10 * k, 10 * k + 1) if k < 10 else (None, 10 * k + 1)
        rows += [(ids[0], base), (ids[1], base + (" " + block) * 50)]
    rows += [(None, some_text(60, 9) + " one"), (900, some_text(60, 9) + " two"), (901, some_text(40, 10))]
    sets = [near_duplicates.shingles(near_duplicates.words(t), near_duplicates.WordHash()) for _, t in rows]
    for a, b in zip(sets[:24:2], sets[1:24:2], strict=True):
        assert near_duplicates.plain_distance(a[0], b[0]) <= 0.2 + 1e-9
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [10 * (i // 2) + (i // 2 >= 10) for i in range(24)] + [900, 900, 901]
    assert sorted((r.class_id, r.n_texts) for r in got) == sorted((c, want.count(c)) for c in want)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (7, 7), (None, 1)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = [(i, (rng.normal(size=8) if i % 3 else np.ones(8)).tolist()) for i in range(400)]
    v += [(i, rng.normal(size=8).tolist()) for i in (0, 0, 7, 7, 100)]  # ids that repeat, with other vectors
    v += [(200, v[200][1]), *[(300, [2.0] * 8)] * 12, (9, [3.0] * 8), (9, [3.0] * 8)]  # rows that repeat
    bad = [(500, None), (600, [1.0, None]), (700, [float("nan")] * 8), (None, [1.0] * 8), (800, [1.0]), (900, [])]
    numbers = exact_topk.whole_numbers(spark.createDataFrame(v + bad, "vec_id long, embedding array<float>"))
    got = exact_topk.top_k(numbers, numbers.where("vec_id % 100 = 0"), shard=150, block=2).collect()
    held = [(r.vec_id, np.array(list(r.v) + [0] * (8 - len(r.v)))) for r in numbers.collect()]
    assert len(held) == len(v) + 2
    want = []
    for row, (q, x) in enumerate(held):
        if q % 100 == 0:
            best = sorted((-int(x @ y), i) for other, (i, y) in enumerate(held) if other != row)[:10]
            want += [(q, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert exact_topk.top_k(numbers.limit(0), numbers.limit(0)).count() == 0


def test_urls(spark):
    canonical = '<html><link rel="canonical" href="%s"></html>'
    rows = [
        (1, "https://a.example.org/x", canonical % "https://b.example.net/es/1"), (2, "http://b.example.net/es/1#t", None),
        (3, "https://WWW.Example.com/en/9?x", ""), (4, "https://m.example.com/en/9", ""), (5, None, None), (6, "no scheme", ""),
        (7, "https://c.example.org/y", canonical % "/z"), (8, "https://c.example.org/z", canonical % "http://q.example.com/"),
    ]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].verdict for i in range(1, 9)] == ["block", "block", "allow", "block", "allow", "allow", "allow", "allow"]
    assert (got[3].host, got[3].path, got[3].rule, got[1].rule, got[5].host) == (
        "www.example.com", "/en/9", "www.example.com/en/", None, ""
    )


def test_references_are_resolved(spark):
    base = "http://a/b/c/d;p?q"  # the examples of RFC 3986, 5.4
    for target, want in [
        ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"),
        ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"),
        ("..", "http://a/b/"), ("../g", "http://a/b/g"), ("../../../g", "http://a/g"), ("/./g", "http://a/g"), ("g:h", None),
        ("/go?to=https://b.net/es/1", "http://a/go?to=https://b.net/es/1"), ("mailto:x?y=http://b.net/", None),
    ]:
        assert url_filter.resolved(target, base) == want, target
    link, fresh = '<link rel="%s" href="%s">', "<meta http-equiv='refresh' content=\"0; %s\">"
    rows = [
        (1, "http://s.net/it/a", link % ("shortlink Canonical", "../es/1")), (2, "http://s.net/it/b", fresh % "url='../es/2'"),
        (3, "http://s.net/es/3?x", ""), (4, "http://s.net/it/p", link % ("canonical", "?id=3")), (5, "http://s.net/it/p?id=3", fresh % "URL=/es/4"),
        (6, "http://c.org/p", link % ("canonical", "/go?to=https://b.net/es/1")), (7, "http://c.org/q", '<base href="http://b.net/es/">' + link % ("canonical", "7")),
        (8, "http://c.org/r", '<link data-href="http://b.net/es/8" rel=canonical href=r2>'), (9, "http://c.org/s", link % ("canonicals", "http://b.net/es/9")),
    ]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 3, 4, 5, 7}


def test_groups_of_aliases_equal_sql_and_brute_force(spark, tmp_path):
    import duckdb

    rng = random.Random(23)
    hosts = ["a.org", "B.net", "example.com", "www.example.com", "m.example.com", "c.org", "d.org"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("/es/1", "/en/1", "/it/2", "", "/it/2?q=1", "/x/3", "/x/4", "/x/5")]
    urls += [f"http://e.org/{i}" for i in range(60)]
    rows = [(i, u, "<p>x</p>") for i, u in enumerate(urls)] + [(900, urls[0], None), (901, None, None), (902, "none", ""), (None, urls[1] + "#f", "")]
    forms = ('<link rel="canonical" href="%s">', '<meta http-equiv="refresh" content="0; url=%s">')
    rows += [(1000 + i, rng.choice(urls), rng.choice(forms) % rng.choice(urls)) for i in range(25)]
    rows += [(2000 + i, f"http://f.org/{i}", rng.choice(forms) % f"http://f.org/{i // 2}") for i in range(1, 9)]  # a chain, then blocked
    rows += [(2100, "http://f.org/0", forms[0] % "http://q.net/fr/z")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, url_filter.judge(frame).collect()), key=str)
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert got == sorted(base.execute(url_filter.OP7_SQL).fetchall(), key=str)

    def node(url):
        rest = url.split("#")[0].split("://")[1]
        host, slash, path = rest.partition("/")
        return host.lower() + "/" + path

    def rule(place):
        host, _, path = place.split("?")[0].partition("/")
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        return max(fits, default=(0, None, None))

    group = {node(u): {node(u)} for _, u, _ in rows if u and "://" in u}
    for _, u, page in rows:
        if u and page and "http" in page:
            a, b = node(u), node(re.search("http://[^\"]*", page)[0])
            joined = group[a] | group.setdefault(b, {b})  # a target need not be a page
            for x in joined:
                group[x] = joined
    verdicts = {}
    for x in group:
        found = {rule(y)[2] for y in group[x]}
        # a host alone has an empty path, which begins with no rule's
        verdicts[x] = rule(x)[2] or ("allow" if "allow" in found else "block" if "block" in found else "allow")
    decided = 0
    for i, host, path, name, verdict in got:
        u = dict((r[0], r[1]) for r in rows)[i]
        if u and "://" in u and path:
            assert verdict == verdicts[node(u)] and name == rule(node(u))[1], (u, verdict)
            decided += name is None and verdict == "block"
    assert decided > 3
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_tags_without_an_end_are_read_in_linear_time():
    n = 1 << 20
    for part in ("<link ", "<meta '", '<link "\'', "<base ", '<link" ="', "<link rel=canonical href='"):
        start = time.perf_counter()
        url_filter.targets((part * n)[:n], "http://a/")
        assert time.perf_counter() - start < 15, part


def test_html(spark):
    page = "<html><head><title>T</title><script>x</p></script></head><body><nav>Menu</nav><div>Site line</div>{}<div class='ad'>Buy</div>"
    rows = [
        (1, "http://h/a/1", page.format("<article><h1>A &amp; B</h1><p>one<br>two <b>x</b>  y<p>three</article><footer>f</footer>")),
        (2, "http://h/a/2", page.format("<div>Own words</div>")), (3, "http://h/a/3", page.format("<p>Other words")),
        (4, "http://h/a/3", page.format("<p>Other words")), (5, None, None), (None, "http://g/", "plain <i>text</i>"),
    ]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {
        1: "A & B\n\none\n\ntwo x y\n\nthree", 2: "Own words", 3: "Other words", 4: "Other words", 5: "", None: "plain text"
    }
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 4, 9), rng.integers(0, 4, 8)
        table = np.zeros((10, 9), int)
        for i in range(9):
            for j in range(8):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        pairs = html_text.common(a, b)
        assert len(pairs) == table[9, 8] and all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_main_text_of_ordinary_pages_stays(spark):
    rows = [
        (1, "http://a/1", "<div>Own text</div><aside><article>teaser</article></aside><footer><article>more</article></footer>"),
        (2, "http://b/1", '<article><h2 id="related-work">Related</h2><section id="search-methods">Ways</section>'
         '<p class="form-factor">Form</p><div class="search">Found</div><div class="ad">Buy</div><div class="comments">Hm</div></article>'),
        (3, "http://c/1", '<div class="site-header">Top</div><p class="form">Words</p><div class="comments"><article>x</article></div>'),
    ]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {1: "Own text", 2: "Related\n\nWays\n\nForm\n\nFound", 3: "Words"}
    # first and last page of a partition are no neighbours; the last of one and the first of the next are
    pairs = html_text.border_pairs([(0, "h", [1, 9]), (1, "h", [2, 9]), (2, "h", [2, 3]), (3, "h", [2, 3])])
    assert pairs == [("h", [2, 9], [2]), ("h", [2, 3], [2])]


def test_attributes_are_read_by_name():
    def kept(page):
        return [x for x, gone in zip(*html_text.lines_of(page)[::2], strict=True) if not gone]

    for opening in ('<div style="overflow:hidden">', '<p title="hidden gem">', "<div data-state='hidden-no'>", '<div data-id="comments">',
                    '<div data-hidden>', '<div title="a < b > class=ad">', '<div class=comments-open>', '<div class="x" class="ad">'):
        assert kept(f"<article><p>Intro</p>{opening}Body</article>") == ["Intro", "Body"], opening
        assert kept(f"<p>Intro</p>{opening}Body") == ["Intro", "Body"], opening
    for gone in ('<div class="comment">', '<section class="reader-comments">', "<ol id='comments_list'>", '<li class="x comment">', '<div HIDDEN>',
                 '<article class="comment">', '<p aria-hidden="true">', "<div class='ad-box'>", '<div role="Search">', "<aside>"):
        assert kept(f"<article><p>Intro</p>{gone}Body") == ["Intro"], gone
    assert kept("<article>a</b>b</div>c</article>d") == ["ab", "c", "d"]
    assert kept("<p>1 <a 2 <b>3</b>") == ["1 <a 2 3"] and kept("x < y <") == ["x < y <"]


def test_pages_that_close_nothing_are_read_in_linear_time():
    n = 1 << 20
    for part in ("<a ", "<script ", "<!", "</", "<a '", '<a "\'', "<a title=\"'", "<i>", "<p><article>", "<link x='", "&", "<!--", "</script", '<a" ="'):
        page = (part * n)[:n]
        for text in (page, "<b>" + page + "</b></i>" * 10_000, "<script>" + page):
            start = time.perf_counter()
            html_text.lines_of(text)
            assert time.perf_counter() - start < 15, part
    deep = "<b>" + "<article>" * 100 + "<i>" * 100_000 + "</b>" * 100_000
    start = time.perf_counter()
    html_text.lines_of(deep)
    assert time.perf_counter() - start < 15


def test_differencing_decides_where_nothing_is_named(spark):
    """Pages without an article: what the neighbour in the order of paths also has goes, as a plain table says."""
    rng = random.Random(12)
    rows, lines = [], {}
    for i in range(60):
        host = f"h{i % 3}"
        own = [f"own {i} {k}" for k in range(rng.randint(0, 4))]
        lines[i] = [f"{host} line {k}" for k in range(6) if rng.random() < 0.7] + own
        rng.shuffle(lines[i])
        rows.append((i, f"http://{host}/{i:03}", "".join(f"<div>{x}</div>" for x in lines[i])))
    rows.append((99, "http://alone/", "<div>only</div>"))
    want = {99: "only"}
    for host in range(3):
        ids = range(host, 60, 3)
        first = {}
        for i in ids:  # pages of equal lines are one
            first.setdefault(tuple(lines[i]), i)
        order = sorted(first, key=first.get)
        shared = {x: set() for x in order}
        for a, b in zip(order, order[1:]):
            at = html_text.common(np.array([hash(x) for x in a]), np.array([hash(x) for x in b]))
            table = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
            assert len(at) == table[-1, -1]
            both = {a[i] for i, _ in at}
            shared[a] |= both
            shared[b] |= both
        for i in ids:
            want[i] = "\n\n".join(x for x in lines[i] if x not in shared[tuple(lines[i])])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in html_text.extract(frame).collect()} == want
    assert html_text.extract(frame.limit(0)).count() == 0


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    rows = [(i, some_text(40, 1000 + i), "en", "s", 0) for i in range(40)] + [(90, some_text(40, 1000), "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    toxicity_first = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert toxicity_first.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = corpus_pipeline.STAGES[1][1](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == set(range(40))
    assert F is not None and [n for n, _ in corpus_pipeline.STAGES][-1] == "byte_bpe"
    assert {r.doc_id for r in toxicity_first.collect()} == {*range(40), 90}  # no labels, no rejection


CLASHES = "c0 string, key string, kept_id string, kept_key long, spans string, base string, terms string, row string, _ow_key string"


def test_all_stages_on_awkward_rows(spark, tmp_path):
    toxic = "hateful scum vermin filth " * 20
    rows = [(i, t) for i, t in TEXTS] + [(100 + i, f"{some_text(30, 60 + i)} {toxic} {some_text(5, 90 + i)}") for i in range(40)]
    rows += [(200 + i, some_text(50, 500 + i)) for i in range(40)] + [(None, some_text(40, 77))] * 3
    extra = ("c", "k", "i", 5, "s", "b", "t", "r", "o")
    table = spark.createDataFrame(
        [(i, t, None, "s", 0, *extra) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
    )
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(100 + i, 0, 1) for i in range(40)] + [(200 + i, 1, 0) for i in range(40)] + [(None, 0, 1), (7, 1, None)],
        "doc_id long, quality int, toxic int",
    ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, BENCH), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before, seen = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == table.columns
        out = corpus_pipeline.materialize(out)
        assert {tuple(r)[5:] for r in out.collect()} <= {extra}
        seen[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        docs = out
    assert set(seen["toxicity"]) < set(before) and not {100 + i for i in range(40)} & {i for i, _ in seen["toxicity"]}
    assert {200 + i for i in range(40)} <= {i for i, _ in seen["toxicity"]}
    left = seen["near_dedup"]
    assert len(left) == len(set(left)) and set(left) <= set(seen["toxicity"])
    assert sum(i is None for i, _ in left) == 2 and {1, 2} & {i for i, _ in left} == {1}  # one of three equal null rows
    assert dict(seen["decontamination"])[7] == "start, . The end"
    assert {x for x in seen["decontamination"] if x[0] != 7} == {x for x in left if x[0] != 7}
    assert "joe.x@" not in dict(seen["pii"])[6] and len(seen["pii"]) == len(left)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in final if r.doc_id is not None) == sorted(
        (i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in seen["pii"] if i is not None
    )


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
