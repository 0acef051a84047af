"""Line runs, spelling variants and whitening against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchboard.llm import line_runs, spelling, whitening
from matchboard.llm.queries import QUERIES

NOTICE = "All rights reserved by the owners of this page, whoever they are"
SCHEMA = "doc_id long, text string, h string, g string, gone string, n int, word string, code int, vector string, `odd name.x` int"
LINES = [
    (i, f"{NOTICE}\nown line number {i} with some more words in it\n \t{NOTICE.upper()} \x0b\r\n{'é' * 39}\n{'é' * 40}" + "\n" * (i % 3)) for i in range(12)
] + [
    (3, f"a row that repeats an id\n{NOTICE}"), (None, f"no id\n{NOTICE}\nÀ{NOTICE}"), (None, NOTICE), (None, f"À{NOTICE}"), (40, None), (41, ""), (42, "\n\n"),
    (20, f"À{NOTICE}"), (21, f"À{NOTICE}"), (22, f"À{NOTICE}\nà{NOTICE}"), (23, "four documents hold this line, which is not enough for it"),
    (24, "four documents hold this line, which is not enough for it"), (25, "four documents hold this line, which is not enough for it"),
    (25, "four documents hold this line, which is not enough for it"), (26, "Four documents hold THIS line, which is not enough for it"), (27, "x" * 300_000 + f"\n{NOTICE}"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", "g", "x", 1, "w", 2, "v", 3) for i, t in rows], SCHEMA)


def plain_lines(rows, min_docs=5, min_chars=40):
    white = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-math.inf if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != (-math.inf if i is None else i) for x in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_line_dedup(spark, rows, batches):
    got = rows(line_runs.deduplicate(frame(spark, LINES), batches=batches, buckets=3))
    assert got == plain_lines(LINES)
    assert max(n for _, _, _, n in got) == 3 and rows(line_runs.deduplicate(frame(spark, []), batches=batches)) == []


def test_runs_are_few_and_exact(spark):
    runs = line_runs.LineRuns(spark, min_docs=3, buckets=2)
    batches = [[(100 - 10 * b - d, h, h % 7) for d in range(4) for h in range(b % 3, 40, d + 1)] for b in range(9)]
    for lines in batches:
        runs.add(spark.createDataFrame(lines, "doc_id long, h long, g long"))
        assert len(runs.runs()) <= 4 and all(len(level) <= 1 for level in runs.levels)
    holders = defaultdict(set)
    for i, h, _ in sum(batches, []):
        holders[h].add(i)
    assert {(r.h, r.last) for r in runs.frequent().collect()} == {(h, max(ids)) for h, ids in holders.items() if len(ids) >= 3}


def test_runs_join_without_shuffling_them(spark):
    runs = line_runs.LineRuns(spark, min_docs=1, buckets=4)
    runs.add(spark.createDataFrame([(9, 1, 1), (8, 2, 2)], "doc_id long, h long, g long"))
    old = runs.runs()[0][1]
    fresh = spark.createDataFrame([(7, 2, 2), (7, 3, 3)], "doc_id long, h long, g long").groupBy("h", "g").agg(F.max("doc_id").alias("last"))
    joined = fresh.join(old.hint("merge"), ["h", "g"], "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") <= 1
    assert [r.h for r in joined.collect()] == [3]


# ---- spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, damage=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: sorted((-words[v], v) for v in words if one_edit(w, v)) for w in words}
    form = {w: v[0][1] if v and -v[0][0] >= 10 * words[w] else None for w, v in near.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_spelling_variants(spark, rows):
    texts = [
        (1, "separate " * 300 + "seperate " * 25 + "seperatte " * 2 + "separate-separate"), (2, "Separate sepArate ÉSEPARATE éseparate Éseparate éseparate"),
        (None, "noiddoc noiddoc noidoc1 noiddocs noiddocs"), (3, None), (4, ""), (5, "short words only"), (6, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
        (7, "q" * 50_000 + " " + "q" * 50_000 + " " + "q" * 50_001 + " " + "q" * 50_001 + " " + " ".join(c * n for c in "wü" for n in (63, 64, 65, 66) for _ in "12")), (8, "tieword tieword tiewore tiewore tiewora tiewora " + "tiewor÷ tiewor÷"), (8, "tieword"),
    ] + [(100 + i, "documentation understanding straße÷x " * 80) for i in range(60)]
    expected = plain_variants(texts)
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    got = rows(spelling.variants(spelling.vocabulary(frame(spark, texts))), *columns)
    assert got == expected
    assert ("seperatte", "seperate", "separate", 2, 1, 25) in got or any(r[1] and r[2] != r[1] for r in got)
    assert rows(spelling.variants(spelling.vocabulary(frame(spark, [])))) == []


def test_no_pair_is_missed(spark):
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcéx"), rng.integers(7, 11))) for _ in range(700)})
    given = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    expected = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert expected
    for symbols in (1, 2, 4):
        got = [(r.word, r.near) for r in spelling.near_words(given, symbols).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_neighbourhoods_are_full():
    words, symbols = ["separat", "oooooooo", "aaaaaaa"], 3
    for word in words:
        reduced = "".join(str(spelling.symbol(c, symbols)) for c in word)
        near = {reduced} | {reduced[:i] + reduced[i + 1 :] for i in range(len(reduced))}
        near |= {reduced[:i] + str(s) + reduced[i + skip :] for i in range(len(reduced) + 1) for s in range(symbols) for skip in (0, 1)}
        found, _ = spelling.neighbourhoods([word], symbols)
        assert len(found) == len({x for x in near if x})


# ---- whitening


def vectors(n, size, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) * np.linspace(1, 2, size) / 8).astype(np.float32)


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, component int, n double")


def test_whitening_against_eigenvectors(spark):
    given = vectors(300, 12)
    bad = [(900, None), (901, [math.nan] + [1.0] * 11), (902, [math.inf] * 12), (903, [None] + [1.0] * 11), (904, [1.0] * 5), (905, [])]
    rows = list(enumerate(given)) + [(None, given[5]), (7, given[7])]
    got = whitening.whiten(table(spark, rows + bad), components=8).collect()
    whole = np.floor(1024 * np.array([v for _, v in rows], dtype=np.float64)) + 100_000
    n, centred = len(rows), whole - whole.mean(axis=0)
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    assert len(got) == 8 * n and {r.n for r in got} == {n} and sorted({r.component for r in got}) == list(range(1, 9))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    expected = centred @ components / np.sqrt(values)
    exact = {}
    for (i, _), x in zip(rows, whole.astype(np.int64).tolist()):
        exact.setdefault(i, sum((n * a - int(s)) ** 2 for a, s in zip(x, whole.sum(axis=0))))
    for k in range(8):
        mine = {r.vec_id: r for r in got if r.component == k + 1}
        sign = np.sign(mine[0].whitened * expected[0, k])
        for at in range(300):
            assert abs(mine[at].whitened * sign - expected[at, k]) < 1e-8
        assert all(int(r.deviation) == exact[i] and abs(r.explained / (values[k] / values.sum()) - 1) < 1e-10 for i, r in mine.items())


def test_equal_eigenvalues(spark):
    corners = [(i, [x, y, z, 0.0]) for i, (x, y, z) in enumerate((x, y, z) for x in (-0.5, 0.5) for y in (-0.5, 0.5) for z in (-0.25, 0.25))]
    got = whitening.whiten(table(spark, corners, "double")).collect()
    assert {r.component for r in got} == {1, 2, 3} and got[0].identity_error < 1e-12  # the fourth has no spread
    shares = {r.component: r.explained for r in got}
    assert np.allclose([shares[k] for k in (1, 2, 3)], [4 / 9, 4 / 9, 1 / 9])


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [])]):
        assert whitening.whiten(table(spark, rows)).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(i, [v, -v / 3, 0.5]) for i, v in enumerate([1e12, -3e11, 5e12, 7.25, 1e3])] + [(9, [1e30, 0.0, 0.0])]
    got = whitening.whiten(table(spark, rows, "double"), components=3).collect()
    whole = [[math.floor(1024 * x) + 100_000 for x in v] for _, v in rows[:-1]]
    sums = [sum(x) for x in zip(*whole)]
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(i, sum((5 * a - s) ** 2 for a, s in zip(x, sums))) for i, x in enumerate(whole)}


def exact_polynomial(matrix):
    """By the recurrence of Faddeev and LeVerrier, in fractions."""
    size = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m, coefficients = [[Fraction(0)] * size for _ in range(size)], [Fraction(1)]
    for k in range(1, size + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(size)) + (coefficients[-1] if i == j else 0) for j in range(size)] for i in range(size)]
        product = sum(a[i][t] * m[t][i] for i in range(size) for t in range(size))
        coefficients.append(-product / k)
    return [int(c) for c in reversed(coefficients)]


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(4)
    half = rng.integers(-(10**6), 10**6, size=(6, 9)).astype(object)
    half[:, 3] = 0
    matrix = half.T.dot(half).tolist()  # of rank 6 at most
    assert whitening.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)
    p = 10_007
    other = rng.integers(0, 50, size=(7, 7)).tolist()
    other[2][0] = other[1][0] = 0  # no pivot at first
    assert whitening.hessenberg_polynomial(other, p) == [c % p for c in exact_polynomial(other)]


def test_roots_with_multiplicity():
    coefficients = [1]
    for root in (0, 0, 3, 3, 3, 7, 1000, 1001):
        coefficients = [(coefficients[i - 1] if i else 0) - root * (coefficients[i] if i < len(coefficients) else 0) for i in range(len(coefficients) + 1)]
    roots = whitening.largest_roots(coefficients, 6)
    assert [(round((r.low + r.high) / 2 ** (r.bits + 1), 9), r.times) for r in roots] == [(1001, 1), (1000, 1), (7, 1), (3, 3)]


def test_primes():
    found = whitening.primes_for(100)
    assert math.prod(found).bit_length() > 100 and all(p < 2**31 and all(p % d for d in range(2, 2000)) for p in found)
    assert [p for p in range(60) if whitening._is_prime(p)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]


def test_queries_have_their_columns(spark):
    folder = "/root/testdata/sf0.001"
    lines = QUERIES["op11_line_dedup"](spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in plain_lines(list(texts.items()))}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines} == expected
    words = QUERIES["op12_spelling_variants"](spark, folder)
    assert sorted((tuple(r) for r in words.collect()), key=repr) == plain_variants(list(texts.items()))
    assert dict(QUERIES["op13_embedding_whitening"](spark, folder).dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
