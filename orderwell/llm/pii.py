"""Personal data: fixed patterns, and terms that give a person away by how they occur in the corpus.

Method (information-theoretic sanitisation). A protected entity is the value of a base match (an e-mail address, an ip
address, a card or a phone number). A term is a word within WINDOW words of such a match in some text; what it tells is
counted in whole texts. Over the groups of copies of the corpus, with N of them, f(e) holding entity e, f(t) holding term
t, and c(t, e) holding both:

    information of e        IC(e)     = log2(N / f(e))
    what t tells about e    PMI(t, e) = log2(N p / f(e)),  p the lower confidence bound of c(t, e) / f(t)

A term discloses e if PMI(t, e) >= threshold * IC(e), so that seeing t alone all but names e. Every pair is judged, however
rare: the bound (Wilson's, one-sided, Z standard deviations) is low where few groups hold t, and what it must reach is low
where e is rare. A group of copies is a class of near duplicates among the texts that hold an entity; of the other texts
only exact copies are one.
Every occurrence of a disclosing term outside base spans, in any text,
becomes a span of kind `term`. Sanitising replaces base spans by their kind, generalises
terms with digits to the pattern of their digits and letters, and removes other terms.

Base kinds: leftmost, not overlapping within a kind; a match that fails its test is dropped and the search goes on after
it. Every scan is linear in the text. Spans are code points, end exclusive.

Rows: one per input row, also for a null id; repeated rows give repeated results. Null and empty texts have no spans.
"""

from __future__ import annotations

import bisect
import re
import string
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import FOLD, arrow_map, by_place, change_rows, read
from orderwell.llm.near_duplicates import near_duplicates
from orderwell.session import materialize

KINDS = ("email", "ip", "card", "phone")

#: Words to either side of an entity that are candidates, and what makes one of them disclose it.
WINDOW = 8
THRESHOLD = 0.9
#: Standard deviations below the observed share: one-sided confidence of 90 %.
Z = 1.2816
#: One in so many texts is looked through first, for a lower bound of f(t) that rules common words out.
LOOK = 16

LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: A word before it is lower-cased.
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
DIGITS = re.compile("[0-9]")

Span = tuple[int, int, str]


def emails(text: str) -> Iterator[Span]:
    """At each @: the longest run of local characters before it that no earlier match took, then a dotted domain."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end(), "email"
            past = m.end()
        else:
            past = at
        at = text.find("@", max(past, at + 1))


def _octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


def base_spans(text: str | None) -> list[Span]:
    """(start, end, kind) by kind as listed, then start."""
    if not text:
        return []
    found = list(emails(text)) if "@" in text else []
    if not DIGITS.search(text):
        return found
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(_octet, m.groups()))]
    for m in CARD.finditer(text):
        if 15 < m.end() - m.start() and 15 < len(d := _digits(m[0])) < 20 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.findall(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return found


def entity_of(kind: str, value: str) -> str:
    """The same entity however it is written."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(DIGITS.findall(value))}"


def terms_near(text: str, spans: list[Span]) -> list[tuple[str, int, int, str]]:
    """(entity, start, end, term) of the words near each base span, none of them inside a base span.

    The words of the text are found once; a word that a span cuts counts with the part before or after the span.
    """
    if not spans:
        return []
    # base spans as disjoint stretches, in order
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    places = [m.span() for m in WORD.finditer(text)]
    firsts, lasts = [a for a, _ in places], [b for _, b in places]
    out = []
    for start, end, kind in spans:
        before = bisect.bisect_left(firsts, start)
        after = bisect.bisect_right(lasts, end)
        near = places[max(0, before - WINDOW) : before] + places[after : after + WINDOW]
        entity = entity_of(kind, text[start:end])
        for k, (a, b) in enumerate(near):
            a, b = (a, min(b, start)) if k < min(before, WINDOW) else (max(a, end), b)
            last = bisect.bisect_left(starts, b) - 1  # the last stretch that begins before the word's end
            if last < 0 or ends[last] <= a:
                out.append((entity, a, b, text[a:b].encode().translate(FOLD).decode()))
    return out


SCAN = """doc_id long, key long, text_key binary, base array<struct<start: int, end: int, kind: string>>,
entities array<string>, near array<struct<entity: string, start: int, end: int, term: string>>"""


def short_key(text: F.Column) -> F.Column:
    """What Spark alone counts texts by."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def scan(documents: DataFrame) -> DataFrame:
    """Base spans, entities and words near them of each row; text_key tells texts apart, key is a short one."""

    def setup():
        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            near = [terms_near(t, s) if s else [] for t, s in zip(texts, base, strict=True)]
            names = ("entity", "start", "end", "term")
            return {
                "doc_id": batch.column("doc_id"),
                "key": batch.column("key"),
                "text_key": [xxhash.xxh3_128_digest(t or "") for t in texts],
                "base": [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in base],
                "entities": [
                    sorted({entity_of(k, t[a:b]) for a, b, k in s}) for t, s in zip(texts, base, strict=True)
                ],
                "near": [[dict(zip(names, x, strict=True)) for x in n] for n in near],
            }

        return work

    docs = documents.select(
        F.col("doc_id").cast("long"), short_key(F.col("text")).alias("key"), F.col("text").cast("string")
    )
    return arrow_map(docs, setup, SCAN)


def copy_groups(documents: DataFrame, holders: DataFrame) -> DataFrame:
    """key, group of the texts (keys) in `holders` that are a near copy of one with a smaller key, the group's."""
    texts = documents.select(short_key(F.col("text")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = materialize(texts.join(holders.select(F.col("key").alias("doc_id")), "doc_id", "left_semi"))
    found = near_duplicates(held).where("doc_id != class_id")
    return found.select(F.col("doc_id").alias("key"), F.col("class_id").alias("group")).distinct()


def lower_bound(together: F.Column, of: F.Column, z: float) -> F.Column:
    """Wilson's lower bound of the share `together` / `of`."""
    p, zz = together / of, z * z
    return (p + zz / (2 * of) - z * F.sqrt(p * (1 - p) / of + zz / (4 * of * of))) / (1 + zz / of)


def words_held(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """key, term: which of the terms each different text holds, anywhere in it.

    Spark sends the terms to all tasks if their stored size is small, and shuffles both sides else.
    """
    folded = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    word = F.split(F.regexp_replace(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " ")
    found = documents.select(short_key(F.col("text")).alias("key"), F.explode(F.array_distinct(word)).alias("term"))
    return found.join(terms, "term").select("key", "term").distinct()


def disclosing_pairs(
    documents: DataFrame, scanned: DataFrame, threshold: float = THRESHOLD, z: float = Z
) -> DataFrame:
    """entity, term, pmi, information of the pairs whose term discloses the entity. `scanned` is a stored scan()."""
    return _judged(documents, scanned, threshold, z)[0]


def _judged(documents: DataFrame, scanned: DataFrame, threshold: float, z: float) -> tuple[DataFrame, DataFrame]:
    """The disclosing pairs, and key, term of all different texts for a set of terms that has theirs."""
    holders = materialize(scanned.where(F.size("entities") > 0).select("key").distinct())
    groups = materialize(copy_groups(documents, holders))
    group = F.coalesce("group", "key").alias("group")
    n = float(scanned.agg(F.count_distinct("key")).first()[0] - groups.count())
    owned = materialize(
        scanned.select("key", F.explode("entities").alias("entity")).distinct()
        .join(groups, "key", "left").select("entity", group).distinct()
    )
    entities = owned.groupBy("entity").agg(F.count("*").alias("f_entity"))
    near = scanned.select("key", F.explode("near").alias("n")).select("key", "n.entity", "n.term").distinct()
    near = materialize(near.join(groups, "key", "left").select("entity", "term", group).distinct())
    near_groups = near.select("term", "group").distinct().groupBy("term").agg(F.count("*").alias("f_near"))
    score = lambda c, f: F.log2(F.lit(n) * lower_bound(c, f, z) / F.col("f_entity"))
    information = F.log2(F.lit(n) / F.col("f_entity"))
    # f(t) is at least f_near and c(t, e) at most f(e): what fails with the best that both allow cannot disclose
    best = score(F.col("f_entity"), F.greatest("f_near", "f_entity"))
    pairs = materialize(
        near.select("entity", "term").distinct().join(entities, "entity").join(near_groups, "term")
        .where(best >= threshold * information).drop("f_near")
    )
    # what a part of the texts holds is a lower bound too: common words go before all their texts are listed
    part = documents.where(F.pmod(short_key(F.col("text")), F.lit(LOOK)) == 0)
    seen = words_held(part, materialize(pairs.select("term").distinct())).join(groups, "key", "left")
    seen = seen.select("term", group).distinct().groupBy("term").agg(F.count("*").alias("f_seen"))
    best = score(F.col("f_entity"), F.greatest("f_seen", "f_entity"))
    pairs = materialize(
        pairs.join(seen, "term", "left").where(F.col("f_seen").isNull() | (best >= threshold * information)).drop("f_seen")
    )
    held = words_held(documents, materialize(pairs.select("term").distinct()))
    held = materialize(held.join(groups, "key", "left").select("key", "term", group))
    by_group = held.select("term", "group").distinct()
    terms = by_group.groupBy("term").agg(F.count("*").alias("f_term"))
    best = score(F.least("f_entity", "f_term"), F.col("f_term"))
    pairs = materialize(pairs.join(terms, "term").where(best >= threshold * information))
    # f(t) is no more than some f(e) here, so that the groups of t are the short way to those that hold both
    together = (
        pairs.select("entity", "term").join(by_group, "term").join(owned, ["entity", "group"], "left_semi")
        .groupBy("entity", "term").agg(F.count("*").alias("together"))
    )
    scored = pairs.join(together, ["entity", "term"]).select(
        "entity", "term", score(F.col("together"), F.col("f_term")).alias("pmi"), information.alias("information")
    )
    disclosing = (F.col("information") > 0) & (F.col("pmi") >= threshold * F.col("information"))
    return scored.where(disclosing), held.select("key", "term")


def term_spans(text: str, terms: set[str]) -> list[tuple[int, int]]:
    """(start, end) of every word among the terms that does not meet a base span."""
    taken = sorted((s, e) for s, e, _ in base_spans(text))
    out, at, past = [], 0, 0
    for m in WORD.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            past = max(past, taken[at][1])
            at += 1
        if past <= m.start() and m[0].encode().translate(FOLD).decode() in terms:
            out.append((m.start(), m.end()))
    return out


def all_term_spans(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """text_key, terms: the spans of all occurrences, for the texts of wanted(key, words)."""

    def setup():
        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            spans = [term_spans(t, set(w)) for t, w in zip(texts, batch.column("words").to_pylist(), strict=True)]
            return {
                "text_key": [xxhash.xxh3_128_digest(t) for t in texts],
                "terms": [[{"start": a, "end": b, "kind": "term"} for a, b in s] for s in spans],
            }

        return work

    texts = documents.select(short_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    found = arrow_map(
        texts.where("text != ''").join(wanted, "key"), setup,
        "text_key binary, terms array<struct<start: int, end: int, kind: string>>",
    )
    # one list per text, not per row: its copies find the same list
    return found.where(F.size("terms") > 0).dropDuplicates(["text_key"])


def find_personal_data(
    documents: DataFrame, threshold: float = THRESHOLD, z: float = Z
) -> DataFrame:
    """doc_id, text_key, base, terms for each row: base and terms are arrays of (start, end, kind)."""
    scanned = materialize(scan(documents))
    pairs, held = _judged(documents, scanned, threshold, z)
    disclosing = materialize(pairs.select("term").distinct())
    wanted = held.join(disclosing, "term").groupBy("key").agg(F.collect_list("term").alias("words"))
    terms = all_term_spans(documents, materialize(wanted))
    none = F.array().cast("array<struct<start: int, end: int, kind: string>>")
    bare = scanned.select("doc_id", "text_key", "base")
    return bare.join(terms, "text_key", "left").withColumn("terms", F.coalesce("terms", none))


def sanitised(text: str | None, base: list[Span], terms: list[Span]) -> str | None:
    """Base spans become their kind in brackets; terms with digits their pattern, other terms nothing."""
    if not text or not (base or terms):
        return text
    out, past = [], 0
    for start, end, kind in sorted([*base, *terms], key=lambda s: (s[0], -s[1])):
        if start >= past:
            old = text[start:end]
            if kind != "term":
                new = f"[{kind.upper()}]"
            elif DIGITS.search(old):
                new = "".join("#" if c.isdigit() else "x" for c in old)
            else:
                new = ""
            out += [text[past:start], new]
        past = max(past, end)
    return "".join(out) + text[past:]


def sanitise(documents: DataFrame) -> DataFrame:
    """The rows of documents, with the text of those that hold personal data replaced and n_chars counted anew.

    Only rows with spans are joined by text; their spans are keyed by the text, so ids need not be unique.
    """
    found = find_personal_data(documents).where((F.size("base") > 0) | (F.size("terms") > 0))
    spans = found.groupBy("text_key").agg(F.first("base").alias("base"), F.first("terms").alias("terms"))
    return replace_texts(documents, spans)


def replace_texts(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows with the text of a text_key of spans(text_key, base, terms) made clean."""
    names = documents.columns
    at = names.index("text")
    given = [F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in names]
    plain = by_place(documents.select(*given))
    keyed = change_rows(plain.withColumn("key", F.lit(None).cast("binary")), partial(_keyed, at))
    # the spans of a part are hashed next to its rows, whose texts need no sorting
    joined = keyed.join(spans.withColumnRenamed("text_key", "key").hint("shuffle_hash"), "key", "left")
    out = change_rows(joined, partial(_cleaned, at)).select(*plain.columns).toDF(*names)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out


def _keyed(at: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [xxhash.xxh3_128_digest(t or "") for t in batch.column(at).to_pylist()]
        place = batch.schema.get_field_index("key")
        return batch.set_column(place, batch.schema.field(place), pa.array(keys, batch.schema.field(place).type))

    return work


def _cleaned(at: int):
    as_spans = lambda x: [(s["start"], s["end"], s["kind"]) for s in x]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at_text = batch.schema.get_field_index(f"c{at}")
        base, terms = batch.column("base"), batch.column("terms")
        hit = [i for i, found in enumerate(base.is_valid().to_pylist()) if found]
        if not hit:
            return batch
        texts, field = batch.column(at_text).to_pylist(), batch.schema.field(at_text)
        for i in hit:
            texts[i] = sanitised(texts[i], as_spans(base[i].as_py()), as_spans(terms[i].as_py()))
        return batch.set_column(at_text, field, pa.array(texts, field.type))

    return work


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(read(spark, folder, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed(F.concat("base", "terms")).alias("spans"),
    )
