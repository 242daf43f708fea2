"""Lattice near-duplicates, exact whitening and periodic runs against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushback.llm import lattice, queries, runs, whiten

TINY = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---- lattice near-duplicates ---------------------------------------------------

def brute_links(rows, threshold=0.98):
    """{row number: (links, smallest id reachable)} of (id, label, vector) rows."""
    good = [i for i, (_, y, v) in enumerate(rows) if y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    for i, j in itertools.combinations(good, 2):
        if rows[i][1] == rows[j][1] and len(rows[i][2]) == len(rows[j][2]):
            a, b = np.array(rows[i][2]), np.array(rows[j][2])
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (rows[i][0], len(near[i]), min(ids) if ids else None)
    return sorted(out.values(), key=str)


def planted_vectors(seed, groups, size=64):
    rng = np.random.default_rng(seed)
    rows = []
    for label, (copies, noise) in enumerate(groups):
        base = rng.normal(size=size)
        for _ in range(copies):
            v = base + noise * np.linalg.norm(base) / math.sqrt(size) * rng.normal(size=size)
            rows.append((int(rng.integers(1 << 40)), label % 3, [float(np.float32(x)) for x in v]))
    return rows


def found_links(spark, rows, kind="double", **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, label int, embedding array<{kind}>, node string")
    found = lattice.near_duplicates(df, **options)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found.collect()), key=str)


def test_lattice_points_are_nearest_and_neighbours_are_the_240_shortest():
    short = lattice.shortest()
    assert len({tuple(v) for v in short.tolist()}) == 240 and np.allclose((short ** 2).sum(axis=1), 2)
    x = np.random.default_rng(0).normal(size=(500, 8)) * 3
    own = lattice.decode(x)
    assert np.all(own * 2 == np.rint(own * 2)) and np.all(own.sum(axis=1) % 2 == 0)
    assert len(np.unique((own * 2) % 2, axis=1)) and all(len(set((r * 2 % 2).tolist())) == 1 for r in own)
    d = ((x - own) ** 2).sum(axis=1)
    others = ((x[:, None] - own[:, None] - short) ** 2).sum(axis=2).min(axis=1)
    assert np.all(d <= others + 1e-12) and d.max() <= 1 + 1e-9  # covering radius 1


def test_links_and_components_equal_brute_force(spark):
    rows = planted_vectors(1, [(30, 0.05), (20, 0.12), (8, 0.3), (40, 0.0), *[(1, 0)] * 120])
    rows += [(rows[0][0], *rows[0][1:]), (None, *rows[1][1:]), (7, None, rows[0][2]), (8, 0, None), (9, 0, []),
             (10, 0, [0.0] * 64), (11, 0, [NAN] * 64), (12, 0, [INF] + [1.0] * 63), (13, 0, [None] + [1.0] * 63),
             (14, 0, [1e300] * 64), (15, 0, [1e-300] * 64), (16, 0, [1.0] * 63)]
    assert found_links(spark, rows) == brute_links(rows)
    plain = [r for r in rows if r[2] is not None and None not in r[2] and not any(abs(x) > 1e30 or 0 < abs(x) < 1e-30 for x in r[2])]
    assert found_links(spark, plain, "float") == brute_links(plain)


def test_blocks_of_any_size_give_the_same_links(spark, monkeypatch):
    rows = planted_vectors(3, [(60, 0.08), (25, 0.1), (1, 0)])
    monkeypatch.setattr(lattice, "TILE", 7)
    found = lattice.counted.__kwdefaults__ | {"count_rows": 9}
    monkeypatch.setattr(lattice.counted, "__kwdefaults__", found)
    monkeypatch.setattr(lattice.links, "__kwdefaults__", lattice.links.__kwdefaults__ | {"block_rows": 8})
    assert found_links(spark, rows) == brute_links(rows)


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(5)
    u = rng.normal(size=(1000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    same = np.zeros(1000, dtype=np.int64)
    for cosine, least in ((0.98, 0.96), (0.99, 0.995)):
        v = cosine * u + math.sqrt(1 - cosine ** 2) * w
        met = np.zeros(1000, dtype=bool)
        for t in range(lattice.TABLES):
            a, b = lattice.cell_keys(u, same, t), lattice.cell_keys(v, same, t)
            met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
        assert met.mean() >= least


def test_no_vectors_no_rows(spark):
    assert found_links(spark, []) == []


# ---- whitening -------------------------------------------------------------------

def leverrier(m):
    """Characteristic polynomial by the Faddeev-LeVerrier recurrence."""
    d = len(m)
    a, mk, c = np.array(m, dtype=object), np.zeros((d, d), dtype=object), [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        mk = a.dot(mk) + np.eye(d, dtype=int).astype(object) * c[d - k + 1]
        c[d - k] = -Fraction(1, k) * sum(a.dot(mk)[i][i] for i in range(d))
    return [int(x) for x in c]


def scatter(rng, t):
    d, n = int(rng.integers(1, 8)), int(rng.integers(1, 9))
    x = rng.integers(-5, 6, size=(n, d)).astype(object)
    if t % 3 == 0:
        x[:, 0] = 0
    if t % 4 == 0 and d > 2:  # equal roots
        x = np.concatenate([np.eye(d, dtype=int) * 2, np.eye(d, dtype=int) * -2]).astype(object)
    return [[int(v) for v in line] for line in x.T.dot(x)]


def test_polynomial_roots_and_null_spaces_of_small_matrices():
    rng = np.random.default_rng(3)
    for t in range(120):
        m = scatter(rng, t)
        p = whiten.primes(whiten.coefficient_bits(m) // 30 + 1)
        residues = np.array([[[v % q for v in line] for line in m] for q in p], dtype=np.int64)
        poly = whiten.remaindered(whiten.hessenberg_polynomials(residues, np.array(p)).tolist(), p)
        assert poly == leverrier(m)
        poly = poly[next(k for k, v in enumerate(poly) if v):]
        if len(poly) == 1:
            continue
        values = np.linalg.eigvalsh(np.array(m, dtype=float))[::-1]
        roots = whiten.largest_roots(poly, 3)
        found = [float(r.value()) for r in roots for _ in range(r.times)]
        assert len(found) >= min(3, len(poly) - 1) and np.allclose(found, values[:len(found)], rtol=1e-9)
        for r in roots:
            whiten.narrow(whiten.without_repeats(poly), r, 200)
            v = np.array(whiten.null_space(m, r, 120), dtype=float)
            assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-14)
            assert np.allclose(np.array(m, dtype=float) @ v.T, float(r.value()) * v.T, atol=1e-9 * max(values[0], 1))


def test_roots_that_doubles_cannot_tell_apart():
    big = 10 ** 20
    poly = [1]
    for root in (big, big + 1, 5, 5):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    roots = whiten.largest_roots(poly, 4)
    assert [r.times for r in roots] == [1, 1, 2]
    assert [round(r.value()) for r in roots] == [big + 1, big, 5]


def test_exact_sums_of_any_long():
    rng = np.random.default_rng(1)
    for bits in (5, 19, 20, 21, 40, 62):
        x = rng.integers(-(1 << bits), 1 << bits, size=(9, 4))
        x[0] = [whiten.LARGEST, whiten.SMALLEST, 0, -1] if bits == 62 else x[0]
        assert (np.array(whiten.exact_products(x), dtype=object) == x.astype(object).T.dot(x.astype(object))).all()
        assert (whiten.unpacked(whiten.packed(x), 4) == x).all()
    assert whiten.integers(np.array([1e300, -1e300, -0.0, 0.999, -0.001]), 256).tolist() == [
        whiten.LARGEST, whiten.SMALLEST, 0, 255, -1]


def whitening(spark, vectors, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n int")
    return whiten.whitened(df, **options).collect()


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    vectors = x.tolist() + x[:40].tolist()  # repeated rows count once in the fit
    vectors += [None, [None] * 6, [NAN] * 6, [INF] * 6, [1.0] * 5, []]
    rows = whitening(spark, vectors)
    q = np.unique(np.floor(256 * x), axis=0)
    n, total = len(q), q.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(q.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == 340 * 4 and {r.n for r in rows} == {n}
    for k in range(4):
        own = sorted((r for r in rows if r.component == k + 1), key=lambda r: r.vec_id)
        want = (np.floor(256 * np.array([vectors[r.vec_id] for r in own])) - total / n) @ axes[:, k] / math.sqrt(values[k])
        got = np.array([r.whitened for r in own])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert abs(own[0].explained - values[k] / values.sum()) < 1e-12 and own[0].identity_error < 1e-12
        for r in own[::50]:
            line = np.floor(256 * np.array(vectors[r.vec_id]))
            assert int(r.deviation) == sum((n * int(v) - int(s)) ** 2 for v, s in zip(line, total))


@pytest.mark.parametrize(("vectors", "components"), [
    ([], 0), ([None], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([[0.0, 1.0], [0.0, 2.0]], 1),
    ([[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0], [0.0, -1.0]], 2), ([[1e300, 1.0], [-1e300, 2.0], [3.0, 4.0]], 2)])
def test_components_exist_as_far_as_variance_does(spark, vectors, components):
    rows = whitening(spark, vectors)
    assert len({r.component for r in rows}) == components
    assert len(rows) == components * len([v for v in vectors if v])
    assert all(r.identity_error < 1e-9 for r in rows)


# ---- periodic runs ----------------------------------------------------------------

def brute_runs(w, least=6, repeats=4):
    n, out = len(w), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                if not any(all(w[x] == w[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                    out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rnd, size):
    n, k = rnd.randrange(0, size), rnd.choice([1, 2, 2, 3, 4, 8, 30])
    w = [b"%d" % rnd.randrange(k) for _ in range(n)]
    if rnd.random() < 0.6 and n:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange(max(1, (n - a) // 4))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_equal_brute_force():
    rnd = random.Random(5)
    for t in range(1500):
        w = random_words(rnd, 60 if t % 50 else 400)
        assert runs.text_runs(w) == brute_runs(w)
        least, repeats = rnd.choice([(2, 2), (3, 3), (6, 2), (4, 2)])
        assert runs.text_runs(w, least, repeats) == brute_runs(w, least, repeats)


def test_extensions_equal_plain_comparison():
    rnd = random.Random(2)
    for _ in range(60):
        s = [1 + rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randrange(2, 90))]
        ahead, n = runs.Extensions([*s, 0]), len(s)
        i, j = (np.array(x) for x in zip(*itertools.permutations(range(n), 2)))
        plain = [next((k for k in range(n) if max(a, b) + k >= n or s[a + k] != s[b + k]), n) for a, b in zip(i, j)]
        assert ahead.between(i, j).tolist() == plain


def test_long_texts_have_their_runs():
    assert runs.text_runs([b"a"] * 30000) == [(0, 30000, 1)]
    w = [b"%d" % (i % 4999) for i in range(30000)]
    assert runs.text_runs(w) == [(0, 30000, 4999)]
    assert len(runs.kept_words(w, [(0, 30000, 4999)])) == 4999
    assert runs.text_runs([b"%d" % i for i in range(30000)]) == []


def test_operator_handles_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \t ", "x"), (None, "a " * 7, "x"), (4, "a b " * 4, "x"),
                                (4, "a b " * 4, "x"), (5, "a b c", "x")], "doc_id int, text string, runs string")
    found = {(r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed)
             for r in runs.periodic_runs(df).collect()}
    assert found == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 7, ((0, 7, 1),), "a"),
                     (4, 8, ((0, 8, 2),), "a b"), (5, 2, (), "a b c")}
    assert runs.periodic_runs(df).count() == 7 and runs.periodic_runs(df.limit(0)).count() == 0


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, TINY).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        w = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want, r = brute_runs(w), found[doc_id]
        assert r.n_runs == len(want)
        top = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None,) * 3
        assert (r.start, r.length, r.period) == top
        assert r.exponent_milli == (1000 * top[1] // top[2] if want else None)
        digest = lambda s: hashlib.sha256(s).hexdigest()
        assert r.runs_sha256 == digest("".join(f"{b},{m},{q}\n" for b, m, q in want).encode())
        drop = {i for b, m, q in want for i in range(b + q, b + m)}
        assert r.collapsed_sha256 == digest(b" ".join(x for i, x in enumerate(w) if i not in drop))


def test_vector_queries_on_a_whole_table(spark):
    table = spark.read.parquet(f"{TINY}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    found = queries.op11_lattice_neardup(spark, TINY).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute_links(rows)
    white = queries.op12_exact_whitening(spark, TINY)
    assert white.count() == 4 * len(rows)
    top = white.agg(F.max("identity_error"), F.min("explained")).first()
    assert top[0] < 1e-9 and top[1] > 0
