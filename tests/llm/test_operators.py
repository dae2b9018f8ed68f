"""The operators on small inputs: brute force, round trips, and NULL, empty, long, repeated and oddly named input."""

import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from billweave.llm import (
    components,
    elias_fano,
    fingerprints,
    jaccard_join,
    language_model,
    line_dedup,
    packing,
    pii,
    piece_bpe,
    quality_rules,
    toxicity,
    url_filters,
)

VOCABULARY, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
# Extra columns carry the names that the operators use themselves.
SCHEMA = "doc_id long, text string, found string, key string, lines string, score double, row_key long"
PASSAGE = " ".join(f"common{i}" for i in range(60))


def _texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    some = [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(12)]
    base = [f"u{i}" for i in range(100)]
    near = " ".join([*base[:50], "changed", *base[51:]])
    return [
        None, "", "  \n ", "x" * 5000, *some, some[0], some[0], "\n".join(["one line", PASSAGE, some[1]]),
        "\n".join([some[2], PASSAGE, "tail"]), " ".join(base), near, "mail me.a@b.example.com. or +1 (017) 555-7713",
        "10.0.0.1 999.1.1.1 x 4111 1111 1111 1111 y 4111111111111112", "é" * 40 + " 日本語 <|endoftext|> ▁ x",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "f", "k", "l", 1.0, 2) for i, t in enumerate(_texts())]
    rows += [(None, "no id at all", None, None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(20)] + [(None, 1, 1), (3, None, None), (999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


def _all(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def _empty(docs):
    return docs.filter("false")


def test_quality_rules(docs, labels):
    def brute(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        covered = {k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)

    doubled = docs.withColumn("text", F.concat_ws(" ## ", "text", "text"))
    for table in (docs, doubled):
        got = sorted(
            (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            for r in quality_rules.judge(table, labels).collect()
        )
        assert got == sorted(brute(t) for _, t in _all(table))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and all(len((r.text or "").split()) >= 20 for r in kept.collect())
    assert quality_rules.judge(_empty(docs), labels).count() == 0
    assert quality_rules.judge(docs, labels.filter("false")).filter("kept").count() > 0


def test_url_filters(spark):
    rng = random.Random(3)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x/", "block"), ("a.b.example.net", "/", "allow")]
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.NET/en/x/1?q#f", "://net", "x://notexample.net/en/"]
    labels_ = ["net", "example.net", "b.example.net", "a.b.example.net", "c.a.b.example.net", "org", "example-x.net"]
    urls += [f"http://{rng.choice(labels_)}{rng.choice(['', '/', '/en/', '/en/x/y', '/de?x'])}" for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(urls)) + [(5, urls[5])], "page_id long, url string")
    by = spark.createDataFrame(rules, "host string, path string, verdict string")

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fit)[1:] if fit else (None, "allow"))

    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(table, by).collect()}
    assert got == {(i, *brute(u)) for i, u in enumerate(urls)}
    assert url_filters.judge(table, by).count() == len(urls) + 1
    assert url_filters.judge(table.filter("false"), by).count() == 0
    assert url_filters.judge(table, by.filter("false")).filter("rule is not null").count() == 0


def test_personal_data(docs):
    found = pii.find(docs.select("doc_id", "text")).select("doc_id", pii.spans_text(F.col("found")).alias("s"))
    spans = {r.doc_id: r.s for r in found.collect()}
    at = {t: i for i, t in enumerate(_texts())}
    mail, numbers = (next(i for t, i in at.items() if t and t.startswith(s)) for s in ("mail", "10.0"))
    assert spans[mail] == "email:5:23,phone:28:45" and spans[numbers] == "ip:0:8,card:21:40"
    cleaned = pii.redact(docs)
    assert cleaned.columns == docs.columns
    assert {r.text for r in cleaned.collect() if r.doc_id == mail} == {"mail [EMAIL]. or [PHONE]"}
    assert cleaned.filter("text is null").count() == 1 and pii.find(_empty(docs)).count() == 0


def _base_spans(text):
    """Base spans by Python's own search: leftmost, non-overlapping per kind."""

    def luhn(digits):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    digits = lambda t: re.sub("[^0-9]", "", t)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 13 <= len(digits(t)) <= 19 and luhn(digits(t))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def test_personal_data_against_plain_search(spark):
    rng = random.Random(9)
    parts = ["a", "b@c.de", ".", "+", " ", "-", "12", "4111 1111 1111 1111", "7.7.7.7", "@", "(", ")", "é", "0", "x.y"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(1500)]
    texts.append(" ".join(rng.choice(["me@there.org", "10.1.2.3,", "word"]) for _ in range(3000)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = F.filter("found", lambda s: s["base"])
    found = {r.doc_id: r.s for r in pii.find(docs).select("doc_id", pii.spans_text(base).alias("s")).collect()}
    assert [i for i, t in enumerate(texts) if found[i] != ",".join(_base_spans(t))] == []


def test_personal_data_in_a_very_long_text(spark):
    parts = [f"from 10.0.{i % 256}.{i % 300} to u{i}@mail.com" for i in range(20_000)]
    docs = spark.createDataFrame([(1, ", ".join(parts))], "doc_id long, text string")
    begun = time.monotonic()
    found = pii.find(docs).select(F.expr("filter(found, s -> s.base)").alias("f")).first().f
    assert len(found) == 20_000 + sum(i % 300 <= 255 for i in range(20_000))
    cleaned = pii.redact(docs).first().text.split(", ")
    assert [p for p, old in zip(cleaned, parts, strict=True) if not p.endswith(" to [EMAIL]") or "u" in p] == []
    assert time.monotonic() - begun < 120


def test_personal_data_that_overlaps_is_replaced_once(spark):
    docs = spark.createDataFrame([(1, "call 10.0.0.1@mail.com now")], "doc_id long, text string")
    assert pii.redact(docs).first().text == "call [IP] now"


def test_all_trusted_documents_count(spark):
    rows = [(i, f"word{i % 7} and some more", 1) for i in range(20_100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    few, many = quality_rules.trusted_ids(docs, broadcast=100), quality_rules.trusted_ids(docs)
    assert few.count() == many.count() == 20_100
    small = docs.filter("doc_id < 300")
    assert quality_rules.fit_ratio(small, few) == quality_rules.fit_ratio(small, many)


def test_running_sums(spark):
    from billweave.llm.common import running

    rows = [(list(range(n)),) for n in (0, 1, 255, 256, 257, 70_000)]
    table = spark.createDataFrame(rows, "v array<int>").select("v", running(F.col("v"), lambda a, x: a + x).alias("r"))
    assert all(r.r == np.cumsum(np.asarray(r.v, np.int32), dtype=np.int32).tolist() for r in table.collect())


def test_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    long = docs.withColumn("text", F.expr("if(doc_id = 6, repeat(text, 400), text)"))
    rows = packing.pack(long, VOCABULARY, public_tokenizers.PATTERN).collect()
    want = []
    for name, text in _all(long):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((str(name), k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert packing.pack(_empty(docs), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_local_search_empties_bins():
    lengths = [6, 5, 4, 5, 4, 6]
    bins = packing.local_search([[0], [1, 2], [3, 4], [5]], lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(6)) and len(bins) == 3
    assert all(sum(lengths[i] for i in b) <= 10 for b in bins)


def test_local_search_finds_what_best_fit_misses():
    lengths = [31, 10, 24, 21, 13, 32, 7, 10, 14, 22, 17, 10, 27]
    first = packing.best_fit(lengths, 61)
    assert len(first) == 5 and len(packing.local_search(first, lengths, 61)) == 4 == -(-sum(lengths) // 61)
    rng = random.Random(8)
    for _ in range(200):
        most = rng.randint(5, 60)
        lengths = [rng.randint(1, most) for _ in range(rng.randint(0, 30))]
        first = packing.best_fit(lengths, most)
        bins = packing.local_search(first, lengths, most)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and len(bins) <= len(first)
        assert all(0 < sum(lengths[i] for i in b) <= most for b in bins)


def test_local_search_ends_on_repeated_rows():
    begin = time.monotonic()
    for size, bins in ((3, 59), (1025, 40_000), (683, 20_000)):
        lengths = [size] * 40_000
        assert len(packing.local_search(packing.best_fit(lengths, 2048), lengths, 2048)) == bins
    assert time.monotonic() - begin < 30


def test_pieces(docs):
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_file=PIECES), piece_bpe.PieceBpe(PIECES)
    rng = random.Random(1)
    texts = ["".join(rng.choices("aetionrsh ▁\né1.,", k=rng.randint(0, 300))) for _ in range(300)] + [" " * 90, "ab" * 3000]
    for text, found in zip(texts, own.encode(texts), strict=True):
        ids = library.encode(text)
        assert found == (len(ids), ",".join(map(str, ids)), library.decode(ids))
    rows = piece_bpe.encode(docs, PIECES, keep_texts=True).collect()
    assert sorted(r.decoded for r in rows) == sorted(library.decode(library.encode(t)) for _, t in _all(docs))


def test_fingerprints(docs):
    rows = fingerprints.with_edits(docs).collect()
    texts = sorted(_all(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (name, text), (_, after) in zip(texts, [*texts[1:], texts[0]], strict=True):
        a, b, c = fingerprints.sketches([text, fingerprints.edited(text, after), after])
        want.append((str(name), len(text), fingerprints.as_text(a), fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint, r.near_edited, r.near_next) for r in rows) == sorted(want)
    assert fingerprints.with_edits(_empty(docs)).count() == 0
    shared = "".join(random.Random(2).choices("abcdefgh ", k=3000))
    one, two = fingerprints.sketches(["other start" + shared, shared + "end"])
    assert fingerprints.likeness(one, two) > 0.8


def test_fingerprints_hold_all_names():
    rng = random.Random(6)
    one, two, shared = ("".join(rng.choices("abcdefgh ", k=k)) for k in (30_000, 30_000, 1000))
    a, b = fingerprints.sketches([one + shared, shared + two])
    assert len(a[2]) > 500 and fingerprints.as_text(a).count(",") == sum(map(len, a)) - len(a)
    assert len(a) > 6 and len(a[-1]) == 1 and len(a[-2]) > 1
    weight = lambda names: sum(fingerprints.GROWTH**i for i, _ in names)
    one, two = ({(i, n) for i, names in enumerate(f) for n in names} for f in (a, b))
    assert fingerprints.likeness(a, b) == pytest.approx(weight(one & two) / weight(one | two)) and one & two
    assert fingerprints.sketches(["", "x", "xx", ""])[0] == [] and fingerprints.likeness([], a) == 0.0


def _phrases(symbols, level):
    """The parsing of one text written as loops over plain numbers."""
    full = (1 << 64) - 1
    step = 0x9E3779B97F4A7C15

    def mixed(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & full
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & full
        return x ^ (x >> 31)

    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    joined = [mixed((s + n * step) & full) for s, n in runs]
    labels, bits = joined, 64
    for _ in range(3):
        tossed = []
        for i, label in enumerate(labels):
            left = labels[i - 1] if i else ~label & ((1 << bits) - 1)
            differing = label ^ left
            place = (differing & -differing).bit_length() - 1
            tossed.append(2 * place + (label >> place & 1))
        labels, bits = tossed, 8
    phrases = []
    for i, label in enumerate(labels):
        left, right = (labels[i - 1] if i else -1), (labels[i + 1] if i + 1 < len(labels) else -1)
        if i == 0 or (i > 1 and label > left and label > right):
            phrases.append([])
        phrases[-1].append(joined[i])
    return [
        mixed(sum(mixed((s + (k + level + 1) * step) & full) for k, s in enumerate(phrase)) & full) for phrase in phrases
    ]


def test_fingerprints_against_slow_parsing():
    rng = random.Random(3)
    texts = ["", "a", "aaaa", "ab" * 50, *["".join(rng.choices("abc é\n", k=rng.randint(1, 3000))) for _ in range(12)]]
    for text, got in zip(texts, fingerprints.sketches(texts), strict=True):
        symbols, want = [ord(c) for c in text], []
        while len(symbols) > (1 if want else 0):
            symbols = _phrases(symbols, len(want))
            want.append(sorted({s >> 20 for s in symbols}))
        assert got == want


def test_fingerprints_texts_are_moved_compressed(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=300)) for _ in range(40)] + ["", "é"]
    rows = [(0, False, i // 2, t, i % 7 == 6) for i, t in enumerate(texts)]
    rows += [(0, True, 99, "after", False), (1, False, None, "no id", True)]
    columns = "block", "copy", "doc_id", "text", "plain"
    types = pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.bool_()
    rows = [(*r[:4], False if r[2] is not None else r[4]) for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], columns)
    moved = list(fingerprints._packed(iter([batch])))
    assert sum(b.nbytes for b in moved) < sum(len(t) for t in texts) / 2
    got = list(fingerprints._unpacked(iter(moved)))
    assert got == sorted((r[:4] for r in rows), key=lambda r: (*r[:2], r[2] or 0, r[3]))

    # However few the shuffle partitions, a range has a bounded size; the rows are those of one range.
    docs = spark.createDataFrame([(i // 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = sorted(fingerprints.with_edits(docs).collect(), key=str)
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 5000)
    in_ranges = fingerprints.with_edits(docs)
    assert in_ranges.rdd.getNumPartitions() > 8 and sorted(in_ranges.collect(), key=str) == want


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels_ = [], []
    for i in range(600):
        words = [f"plain{rng.randint(0, 400)}" for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randint(0, 29)] = rng.choice(["badword", "worseword"])
        rows.append((i, " ".join(words)))
        labels_.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None), (7000, "")], "doc_id long, text string")
    labels = spark.createDataFrame(labels_, "doc_id long, toxic int")
    machine = toxicity.train(docs, labels)
    got = toxicity.score(docs, machine).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in [*range(600), 7000] if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in held if r.doc_id < 600)
    assert toxicity.score(docs, toxicity.train(docs, labels.filter("toxic = 0"))).filter("score > 0.3").count() == 0


def test_toxicity_of_terms_that_tell_only_together(spark):
    rng = random.Random(8)
    rows = []
    for i in range(2400):
        words = [f"plain{rng.randint(0, 400)}" for _ in range(20)]
        words += [["insult", "group"], ["insult"], ["group"], []][i % 4]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2400)], "doc_id long, toxic int")
    held = [r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect() if r.held_out]
    wrong = [r for r in held if r.predicted != (r.doc_id % 4 == 0)]
    assert len(held) > 500 and len(wrong) <= len(held) // 50


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(50)] + [(i, "x y z") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] * 2, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT_TERMS", 2)
    rows, counts = toxicity.sample(docs, labels, per_class=5)
    assert sorted(r.toxic for r in rows.collect()) == [0] * 5 + [1] * 5
    assert all(len(r.terms) <= 2 for r in rows.collect()) and sum(counts.values()) < 100
    machine = toxicity.train(docs.filter("false"), labels)
    assert toxicity.score(docs.filter("false"), machine).count() == 0


def test_line_dedup(docs):
    result = line_dedup.dedup(docs)
    assert result.columns == docs.columns and result.count() == docs.count()
    texts = {r.doc_id: r.text for r in result.collect()}
    holders = [i for i, t in enumerate(_texts()) if t and PASSAGE in t]
    assert PASSAGE in texts[holders[0]] and all(PASSAGE not in texts[i] for i in holders[1:])
    assert texts[holders[1]].endswith("\ntail") and texts[0] is None
    assert line_dedup.dedup(_empty(docs)).count() == 0


def test_line_dedup_deletes_every_long_run(spark):
    rng = random.Random(8)
    lines = [" ".join(f"l{k}w{i}" for i in range(rng.choice([3, 8, 26, 30, 60]))) for k in range(25)]
    texts = [line for line in lines if len(line.split()) == 26]  # alone first, then in runs
    for _ in range(60):
        at = rng.randint(0, 20)
        texts.append("\n".join([*rng.choices(lines, k=2), *lines[at : at + 4], *rng.choices(lines, k=2)]))
    got = line_dedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    seen = set()
    for r in sorted(got, key=lambda r: r.doc_id):
        own = texts[r.doc_id].split("\n")
        for b in range(len(own)):
            for e in range(b + 1, len(own) + 1):
                run = tuple(own[b:e])
                if sum(len(line.split()) for line in run) >= 50:
                    if run in seen:
                        own_left = r.text.split("\n")
                        assert not any(line in own_left and own.count(line) == 1 for line in run), (r.doc_id, b, e)
                    seen.add(run)


def test_jaccard_join(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 2)
    rows = jaccard_join.join(docs).collect()
    texts = _all(docs)

    def shingles(text):
        w = text.encode().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in texts]
    want = []
    for i, (name, text) in enumerate(texts):
        alike = [
            k
            for k, (_, other) in enumerate(texts)
            if k != i and (other == text or (sets[i] and sets[k] and len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k])))
        ]
        want.append((str(name), len(alike)))
    assert sorted((str(r.doc_id), r.n_links) for r in rows) == sorted(want)
    near = [i for i, t in enumerate(_texts()) if t and t.startswith("u0 ")]
    assert {r.class_id for r in rows if r.doc_id in near} == {near[0]}
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.class_id for r in rows})
    assert jaccard_join.join(_empty(docs)).count() == 0


def test_jaccard_join_with_empty_blocks(spark, monkeypatch):
    # A group has far more blocks than texts here.
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 40)
    texts = []
    for g in range(4):
        words = [f"g{g}w{k}" for k in range(100)]
        texts += [" ".join([*words[:at], "changed", *words[at + 1 :]]) for at in range(g + 2)]
    rows = jaccard_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    want = {i: sum(i != k and len(a & b) >= 0.8 * len(a | b) for k, b in enumerate(sets)) for i, a in enumerate(sets)}
    assert {r.doc_id: r.n_links for r in rows} == want and min(want.values()) == 1


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard_join.least_matches()
    assert all(0 < least[k] < 0.8 * k for k in least)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_elias_fano():
    rng = np.random.default_rng(1)
    for top, n in ((1 << 48, 1000), (100, 50), (5, 300), (0, 3), (10**6, 0)):
        values = np.sort(rng.integers(0, top + 1, n, dtype=np.uint64))
        code = elias_fano.EliasFano(values, top)
        assert n == 0 or (code.access(np.arange(n)) == values).all()
        asked = np.unique(np.r_[values, rng.integers(0, top + 1, 50, dtype=np.uint64)])
        for value, at in zip(asked.tolist(), code.find(asked).tolist(), strict=True):
            assert (at >= 0) == (value in set(values.tolist())) and (at < 0 or values[at] == value)


@pytest.mark.parametrize("shard_tokens", [100, 10**6])
def test_language_model(docs, monkeypatch, shard_tokens):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", shard_tokens)
    rows = language_model.score(docs).collect()
    texts = [(n, t.encode().lower().split()) for n, t in _all(docs)]
    held = [n is not None and zlib.crc32(str(n).encode()) % 7 == 2 for n, _ in texts]
    counts = {}
    for (_, words), out in zip(texts, held, strict=True):
        for w in [] if out else [*words, None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for (name, words), out in zip(texts, held, strict=True):
        tokens = [*words, None]
        base = sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        want.append((str(name), out, len(tokens), sum(w in counts for w in tokens), n, round(base, 6)))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == sorted(want) and all(r.score < 0 for r in rows)
    assert language_model.score(_empty(docs)).count() == 0


@pytest.mark.parametrize("most_split", [1, 1000])
def test_language_model_has_one_formula(docs, monkeypatch, most_split):
    monkeypatch.setattr(language_model, "MOST_SPLIT", most_split)
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 300)
    texts = [(n, t.encode().lower().split()) for n, t in _all(docs)]
    held = [n is not None and zlib.crc32(str(n).encode()) % 7 == 2 for n, _ in texts]
    ones, pairs = {}, {}
    for (_, words), out in zip(texts, held, strict=True):
        for context, token in [] if out else zip([b" begin", *words], [*words, b" end"], strict=True):
            ones[token] = ones.get(token, 0) + 1
            own = pairs.setdefault(context, {})
            own[token] = own.get(token, 0) + 1
    n, v = sum(ones.values()), len(ones)

    def log_p(context, token):
        own = pairs.get(context, {})
        kinds, total = len(own), sum(own.values())
        if token in own:
            return np.log10(total / (kinds + total) * own[token] / total)
        return np.log10((kinds / (kinds + total) if own else 1) * (ones.get(token, 0) + 1) / (n + v + 1))

    want = sorted((str(i), sum(map(log_p, [b" begin", *w], [*w, b" end"])), len(w) + 1) for i, w in texts)
    got = sorted((str(r.doc_id), r.score) for r in language_model.score(docs).collect())
    for (i, score, tokens), (name, found) in zip(want, got, strict=True):
        assert i == name and abs(score - found) <= 1e-4 * tokens + 1e-6


def test_windows_of_words_are_hashed_by_halves(spark):
    """Words inside windows that are found twice, against a count in Python; no window is cut out of the text."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 7, 8, 9, 15, 16, 60, 400)]
    texts += ["\x0b\t \n x&# \n\x0c\n x&# \n", "é|ü  <é>\r\n$", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = quality_rules.base_counts(docs)
    assert "translate(" not in counted._jdf.queryExecution().optimizedPlan().toString()
    for row in counted.collect():
        text = texts[row.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        assert (row.n_words, row.n_repeat_words) == (len(words), len(inside))
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
    hashes = spark.createDataFrame([([1, 2, 3] * 5,)], "h array<long>")
    windows = hashes.select(quality_rules._windows(F.col("h"))).first()[0]
    assert len(windows) == 8 and len(set(windows)) == 3 and windows[:3] == windows[3:6]
