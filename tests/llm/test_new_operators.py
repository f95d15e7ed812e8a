"""Spelling variants, resampling and license scans against plain loops, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from orderwell.llm import license_scan, resampling, spelling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, w string, n long, word string, line string, row string, key string, lines string"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, *["x", 1, "y", "z", "r", "k", "l"]) for i, t in rows], DOCS).repartition(parts)


def prose(rng, n, letters="abcdeé", longest=9):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(n))


AWKWARD = [(None, None), (1, None), (2, ""), (2, ""), (3, " \n\n .,"), (None, "Ünïcode ×÷ 漢字 𝒳 naïve\u0000nul"), (4, "a" * 60_000)]


# ------------------------------------------------------------- spelling
def slow_spelling(rows, slips=True):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def edits(w):
        letters = {c for x in words for c in x}
        for i in range(len(w) + 1):
            yield from (w[:i] + c + w[i:] for c in letters)
            if i < len(w):
                yield w[:i] + w[i + 1 :]
                yield from (w[:i] + c + w[i + 1 :] for c in letters)

    out, forms = {}, {}
    for w, n in words.items():
        near = {x for x in edits(w) if x in words and x != w}
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 5 * n else None
        forms[w] = form
        out[w] = [form, w, n, len(near), words[form] if form else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {(w, *v) for w, v in out.items()}


def got_spelling(df, slips=True):
    rows = spelling.group_variants(df, slips=slips).collect()
    assert len(rows) == len({r.word for r in rows})
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_equals_all_edits_of_all_words(spark):
    rng = random.Random(3)
    for letters in ("ab", "abcé÷", "abcdefgh"):
        base = ["".join(rng.choices(letters, k=rng.randint(5, 11))) for _ in range(25)]
        variants = []
        for w in base:
            for _ in range(6):
                i = rng.randrange(len(w) + 1)
                variants.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
        pool = base * 30 + variants
        rows = [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in rng.choices(pool, k=70))) for i in range(60)]
        rows += AWKWARD + [(7, "slipped-word " * 40), (7, "slipped-word " * 40)]
        assert got_spelling(table(spark, rows)) == slow_spelling(rows)


def test_spelling_follows_long_ways_and_keeps_ties(spark):
    way = ["abcdef", "abcdeg", "abcdhg", "abcihg"]  # each one edit from the next
    rows = [(1, " ".join(sum(([w] * 5 ** (i + 1) for i, w in enumerate(way)), [])) + " tiedaa" * 25 + " tiedab" * 25 + " tiedac" * 5)]
    got = got_spelling(table(spark, rows), slips=False)
    assert got == slow_spelling(rows, slips=False)
    assert {r[0]: r[2] for r in got}["abcdef"] == "abcihg"
    assert {r[0]: r[1] for r in got}["tiedac"] == "tiedaa"


def test_spelling_of_nothing(spark):
    assert spelling.group_variants(table(spark, []), slips=True).count() == 0
    assert spelling.group_variants(table(spark, AWKWARD[:5])).count() == 0


# ----------------------------------------------------------- resampling
def features(text):
    words = WORD.findall(lowered(text))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def slow_resampling(rows, target):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10000 for f in features(text)[0]]

    s = Counter(b for _, t in rows for b in buckets(t))
    t = Counter(b for x in target for b in buckets(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    scored = []
    for i, text in rows:
        own = [gain[b] for b in buckets(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([i, len(own), weight, score, features(text)[1]])
    rivals = sorted((x for x in scored if x[4] >= 20), key=lambda x: (-x[3], -(2**63) if x[0] is None else x[0]))
    ranks = {id(x): k + 1 for k, x in enumerate(rivals[: 25 * len(rivals) // 100])}
    return sorted(((*x[:4], ranks.get(id(x))) for x in scored), key=str)


def test_resampling_equals_a_plain_count(spark):
    rng = random.Random(8)
    shared = [prose(rng, 12) for _ in range(6)]
    rows = []
    for i in range(120):
        lines = [rng.choice(shared) if rng.random() < 0.4 else prose(rng, rng.randint(0, 25)) for _ in range(rng.randint(0, 5))]
        rows.append((i, "\n".join(lines).replace(" ", rng.choice([" ", ", ", "  "])) + rng.choice(["", "\n", "\r\n."])))
    rows += [(500 + i, shared[0]) for i in range(60)] + AWKWARD + [(None, prose(rng, 30))]
    target = [prose(rng, 40) + "\n" + shared[1], None, "", shared[2] * 2]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(table(spark, rows), goal)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow_resampling(rows, target)


def test_resampling_without_rows_or_target(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(table(spark, []), none).count() == 0
    rows = [(i, prose(random.Random(i), 30)) for i in range(9)]
    got = resampling.resample(table(spark, rows), none)
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow_resampling(rows, [])


# ------------------------------------------------------------- licenses
def slow_licenses(text):
    words = WORD.findall(lowered(text))
    places = [
        (i, label) for phrase, label in license_scan.PHRASES for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    labels, best = {x for _, x in places}, 0.0
    for label, template in license_scan.TEMPLATES:
        seq = license_scan.template_words(template)
        m, tokens = len(seq), set(seq)
        for k in range(max(1, -(-len(words) // m) - 1)):
            part = len(tokens & set(words[k * m : k * m + 2 * m])) / len(tokens)
            if part * 100 >= license_scan.THRESHOLD - 1e-9:
                labels.add(label)
                best = max(best, part)
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), 1.0 if places else best,
    )


def test_licenses_equal_all_blocks_against_all_templates(spark, tmp_path):
    rng = random.Random(4)
    rows = list(AWKWARD)
    for i in range(150):
        words = prose(rng, rng.randint(0, 200)).split()
        for _ in range(rng.randint(0, 2)):
            _, template = rng.choice(license_scan.TEMPLATES)
            put = [w for w in re.findall(r"\S+", template) if rng.random() > rng.choice([0, 0.03, 0.1, 0.2])]
            if rng.random() < 0.3:
                rng.shuffle(put)
            at = rng.randint(0, len(words))
            words[at:at] = put
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(["MIT License", "cc, by", "mit license mit LICENSE", "GNU General Public License", "apache"]).split()
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    rows += [(1, rows[-1][1])] * 3
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = license_scan.op13_licenses(spark, str(tmp_path))
    want = sorted(((i, *slow_licenses(t)) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(1 for x in want if x[6] != x[5]) > 20  # labels only the join adds


def test_licenses_by_sql_and_of_nothing(spark, tmp_path):
    import duckdb

    table(spark, AWKWARD + [(9, "Licensed under CC BY-NC 4.0."), (10, dict(license_scan.TEMPLATES)["isc"])], 1).select(
        "doc_id", "text"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(license_scan.OP13_SQL)
    got = license_scan.op13_licenses(spark, str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
    assert license_scan.scan_licenses(table(spark, [])).count() == 0


def test_license_plan_has_no_python_and_no_shuffle_of_texts(spark, tmp_path):
    table(spark, AWKWARD).write.parquet(f"{tmp_path}/documents.parquet")
    plan = license_scan.op13_licenses(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_operators_read_no_other_columns(spark):
    rows = [(1, "one two three " * 9)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    goal = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    for apply in (license_scan.scan_licenses, spelling.group_variants, lambda d: resampling.resample(d, goal)):
        assert apply(plain).collect() == apply(table(spark, rows)).collect()
