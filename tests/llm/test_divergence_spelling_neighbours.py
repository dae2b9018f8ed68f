"""Source divergence, spelling variants and nearest neighbours against brute force, and on odd inputs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from billweave.llm import cross_polytope, divergence, k2tree, spelling

# Extra columns carry the names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value double, word string, key string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 0.5, "w", "k") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeéÿz", k=rng.randint(6, 9))) for _ in range(60)]
    words += [w[:3] + rng.choice("abé") + w[rng.choice([3, 4]) :] for w in words]
    rows = []
    for i in range(120):
        text = rng.choice([" ", "-", "\x00"]).join(rng.choices(words, k=rng.randint(0, 40), weights=range(len(words), 0, -1)))
        rows.append((i, text.upper() if i % 7 == 0 else text, rng.choice(["a", "b", "", None]), rng.choice(["s1", "s2", "ß", "", None])))
    long = "".join(rng.choices("xy", k=3000))
    rows += [(200, long + " " + long[:-1], "a", "s1"), (201, long, "a", "s1"), (202, long[1:], "a", "only")]
    rows += [(None, None, None, None), (None, "÷×÷×÷×÷ aaaaaaa aaaaaaaa", None, "s2"), (300, "", "empty", "x"), (301, " 日本語 ", "empty", "y")]
    return rows + [rows[5], rows[5]]


def _brute_divergence(rows, min_docs, top):
    docs = [[x or "" for x in r[1:4]] for r in rows]
    groups = sorted({(lang, source) for _, lang, source in docs})
    cells, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in terms]
        cells[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()

    def ranked(lang, source, part, values, top):
        values.sort(key=lambda x: (-x[1], x[0].encode()))
        out.update((lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(values[:top]))

    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(cells[g])

        def share(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        p, q = share(cells[lang, source]), share(whole)
        pairs = []
        for other in (s for lg, s in groups if lg == lang and s != source):
            r = share(cells[lang, other])
            pairs.append((other, sum(abs(p[t] - r[t]) for t in kept)))
        ranked(lang, source, "pair", pairs, None)
        over = [(t, p[t] - q[t]) for t in kept if cells[lang, source][t] and p[t] > q[t]]
        ranked(lang, source, "term", over, top)
    return out


def test_source_divergence(spark, texts):
    docs = _table(spark, texts)
    for min_docs, top, rows, columns in ((2, 50, 192, 2048), (1, 4, 1, 5), (9, 3, 2, 7), (10_000, 50, 192, 2048)):
        got = divergence.audit(docs, min_docs, top, rows, columns)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert {tuple(r) for r in got.collect()} == _brute_divergence(texts, min_docs, top)
    assert divergence.audit(docs.filter("false")).count() == 0


def test_long_texts_are_counted_in_slices(spark, texts, monkeypatch):
    whole = {(0, r[1], "x", "y") for r in texts if r[1]}
    expected = _brute_divergence(list(whole), 1, 50)
    monkeypatch.setattr(divergence, "_SLICE_BYTES", 20)
    n, docs = Counter(), Counter()
    for _, text, _, _ in whole:
        divergence._count(text.encode(), n, docs)
    assert len(n) and {t.decode() for t in n} >= {x[3] for x in expected if x[2] == "term"}
    assert max(docs.values()) <= len(whole)


def test_k2_trees_price_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(40):
        n_columns = int(rng.integers(0, 70))
        sides = []
        for n_rows in rng.integers(1, 30, 2):
            zero = rng.integers(0, 50, n_rows)
            matrix = np.repeat(zero[:, None], n_columns, 1)
            rows, columns = np.nonzero(rng.random(matrix.shape) < rng.choice([0, 0.02, 0.3, 0.9]))
            matrix[rows, columns] = values = rng.integers(50, 900, len(rows))
            sides.append((matrix, rows, columns, values, zero))
        height = k2tree.height_of(max(len(s[4]) for s in sides), n_columns)
        one, two = (k2tree.K2Tree(*s[1:], height) for s in sides)
        expected = np.abs(sides[0][0][:, None] - sides[1][0][None]).sum(-1)
        assert (k2tree.pair_distances(one, two, n_columns) == expected).all()


def _brute_spelling(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w if h % 31 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and len(b) - len(a) <= 1 and a[i + (len(a) == len(b)) :] == b[i + 1 :]

    all_near = {w: [v for v in n if near(w, v)] for w in n}
    forms = {w: min(v, key=lambda x: (-n[x], x), default=None) for w, v in all_near.items()}
    forms = {w: f if f is not None and n[f] >= 10 * n[w] else None for w, f in forms.items()}

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {(w, forms[w], root(w), n[w], len(all_near[w]), n.get(forms[w])) for w in n}


def test_spelling_variants(spark, texts):
    chain = [("common" + "x" * 3, 2000), ("commonxx", 150), ("commonx", 12), ("commony", 2), ("commonz", 2)]
    rows = [*texts, *((1000 + i, " ".join([w] * n), "a", "s") for i, (w, n) in enumerate(chain))]
    for symbols in (1, 2, 4, 16):
        got = spelling.group(_table(spark, rows), symbols)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in got.collect()} == _brute_spelling(rows)
    roots = {r.word: r.root for r in got.collect()}
    assert roots["commonx"] == "commonxxx" and roots["commonxxx"] == "commonxxx"
    assert spelling.group(_table(spark, rows).filter("false")).count() == 0


def _vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 24))
    x = centers[rng.integers(0, 30, 3000)] + 0.7 * rng.normal(size=(3000, 24))
    x *= np.exp2(rng.integers(-3, 4, 3000))[:, None] * rng.uniform(0.8, 1.3, 3000)[:, None]
    x[::9] = x[0]  # a ninth of the rows are the same vector
    rows = [(i * 5, [float(np.float32(v)) for v in x[i]], "x", 1) for i in range(3000)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, None], [2.0, 1.0], [1.0, 2.0], [1.0, 2.0]]
    rows += [(20 * i + 100_000, v, "x", 1) for i, v in enumerate(odd)]
    rows += [(None, rows[1][1], "x", 1), rows[8], rows[8]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string, rank int"), rows


def test_nearest_neighbours(spark):
    table, rows = _vectors(spark)
    got = defaultdict(list)
    for r in cross_polytope.nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    found = total = 0
    for dim in (2, 24):
        ids, x = zip(*sorted((i, v) for i, v in good if len(v) == dim))
        ids, x = np.array(ids), np.array(x)
        for q in np.flatnonzero(ids % 20 == 0):
            scores = np.cumsum(x * x[q], axis=1)[:, -1]
            best = [j for j in np.lexsort((ids, -scores)) if j != q][:20]
            mine = got.pop(int(ids[q]), [])
            assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
            assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
            by_id = dict(zip(ids.tolist(), scores.tolist()))
            assert all(by_id[v] == s and v != ids[q] for _, v, s in mine)
            found += len({v for _, v, _ in mine} & set(ids[best].tolist()))
            total += len(best)
    assert not got and found >= 0.9 * total
    assert cross_polytope.nearest(table.filter("false"), F.lit(True)).count() == 0


def test_large_cells_are_split(spark, monkeypatch):
    table, _ = _vectors(spark)
    whole = {tuple(r) for r in cross_polytope.nearest(table, F.col("vec_id") % 20 == 0, recall=1.0).collect()}
    monkeypatch.setattr(cross_polytope, "CELL_ROWS", 40)
    monkeypatch.setattr(cross_polytope, "MOST_CELLS", 1)  # one hash a cell all the same
    parts = {tuple(r) for r in cross_polytope.nearest(table, F.col("vec_id") % 20 == 0, recall=1.0).collect()}
    assert len(whole & parts) > 0.95 * len(whole) and len(whole) == len(parts)


def test_several_hashes_per_cell():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 10))
    h = cross_polytope._Hash(10, 0.5, 2.0, 3_000_000, 0)
    assert h.functions == 3 and h.grows
    probes = h.probes(rows[:3], 500)
    assert probes.shape == (3, 500) and all(len(set(p)) == 500 for p in probes.tolist())
    equal = cross_polytope._Hash(10, 1.0, 1.0, 3_000_000, 0)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    assert (equal.probes(units, 1)[:, 0] == equal.cells_of(units)).all()
