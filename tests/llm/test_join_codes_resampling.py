"""Exact kNN join, product codes and importance resampling against brute force, and on nulls, copies, ties and empty tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meteoframe.llm import importance, member_lloyd, queries, voronoi
from meteoframe.llm.common import table

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, score double, id long, cell int, v string"


def brute_nearest(rows, is_query, k):
    """rows: (id, vector of integers), ids unlike."""
    out = []
    for i, q in rows:
        if is_query(i):
            found = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in rows if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ------------------------------------------------------------------ exact top-k join

JOIN = ("query_id", "rank", "vec_id", "score")


def test_join_equals_brute_force_on_the_whole_table(spark):
    rows = [(r["vec_id"], [math.floor(256.0 * float(x)) for x in r["embedding"]]) for r in table(spark, SF, "embeddings").collect()]
    got = queries.QUERIES["op11_voronoi_knn"](spark, SF)
    assert tuples(got, *JOIN) == brute_nearest(rows, lambda i: i % 50 == 0, 5)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_join_with_copies_ties_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = {i: (rng.integers(-3, 4, size=6) / 4).tolist() for i in range(1, 240)}  # many equal scores
    for i in range(3, 240, 3):  # a third of all rows are copies
        vectors[i] = [0.5, -0.25, 0.75, 0.0, 1.0, -1.0]
    vectors[10] = [0.0] * 6
    vectors[20] = [0.25, 0.5]  # shorter: as if zeros followed
    vectors[30] = []
    odd = [(500, None), (501, [1.0, None, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows = [(i, v, 1, 1.0, 7, 3, "x") for i, v in [*vectors.items(), *odd]]
    df = spark.createDataFrame(rows + rows[:40], VECTORS)  # repeated rows count once
    monkeypatch.setattr(voronoi, "BLOCK_ROWS", 16)  # several blocks and several query groups even here
    monkeypatch.setattr(voronoi, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(voronoi, "GROUP_QUERIES", 5)
    got = tuples(voronoi.search(df, F.col("id") % 5 == 0, 4), *JOIN)
    plain = [(i, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v in vectors.items()]
    assert got == brute_nearest(plain, lambda i: i % 5 == 0, 4)


def test_join_of_few_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1, 1.0, 7, 3, "x"), (50, [0.5, 0.5], 1, 1.0, 7, 3, "x")], VECTORS)
    assert tuples(voronoi.search(df, F.col("id") % 50 == 0), *JOIN) == [(0, 1, 50, 256 * 128 * 3), (50, 1, 0, 256 * 128 * 3)]
    assert voronoi.search(df.filter("vec_id = 0"), F.col("id") % 50 == 0).count() == 0
    assert voronoi.search(df.filter("false"), F.col("id") % 50 == 0).count() == 0


def test_join_bounds_never_exclude_a_neighbour_and_do_exclude_rows():
    rng = np.random.default_rng(0)
    heart = rng.normal(size=(40, 16)) * 40
    x = np.floor(heart[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 4).astype(np.int64)
    norm = float(np.sqrt((x * x).sum(axis=1).max()))
    data, k = voronoi.on_sphere(x, norm), 6
    sample = data[:800]
    centre = voronoi.pivots(sample, 60)
    far = voronoi.angles(data, centre)
    cell, angle = far.argmin(axis=1), far.min(axis=1)
    inner = np.full((len(centre), k), np.inf)
    for c in range(len(centre)):
        some = np.sort(angle[cell == c])[:k]
        inner[c, :len(some)] = some
    q = x[::100]
    _, low, high = voronoi.query_bounds(voronoi.directions(q), centre, inner, sample, k, 4)
    kept = (angle[None, :] >= low[:, cell]) & (angle[None, :] <= high[:, cell])
    score = q @ x.T
    edge = np.sort(score, axis=1)[:, -k]
    assert all(kept[r][score[r] >= edge[r]].all() for r in range(len(q)))
    assert kept.mean() < 0.2


# ------------------------------------------------------------------ product codes

CODES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def brute_codes(rows, parts, entries, rounds):
    """rows: (id, vector of integers, label)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    part = [[r[1][p * width:(p + 1) * width] for r in rows] for p in range(parts)]
    books = [[list(x) for x in part[p][:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda p: [min((away(x, c), e) for e, c in enumerate(books[p])) for x in part[p]]
    for _ in range(rounds):
        for p in range(parts):
            found = pick(p)
            for e in range(len(books[p])):
                own = [x for x, (_, at) in zip(part[p], found) if at == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = [pick(p) for p in range(parts)]
    error = [sum(found[p][i][0] for p in range(parts)) for i in range(len(rows))]
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(r[0], "".join(f"{found[p][i][1]:02x}" for p in range(parts)), error[i], by_label[r[2]], sha) for i, r in enumerate(rows)]


def test_codes_equal_brute_force_on_the_whole_table(spark):
    rows = [(r["vec_id"], [math.floor(256.0 * float(x)) for x in r["embedding"]], r["label"]) for r in table(spark, SF, "embeddings").collect()]
    got = queries.QUERIES["op12_member_lloyd_codes"](spark, SF)
    assert tuples(got, *CODES) == sorted(brute_codes(rows, 16, 64, 2))


@pytest.mark.parametrize("rounds", [1, 3])
def test_codes_with_copies_nulls_and_salted_owners(spark, monkeypatch, rounds):
    monkeypatch.setattr(member_lloyd, "SALT_ROWS", 20)
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.integers(-40, 40, size=8) / 16).tolist(), [None, 1, 2][i % 3]) for i in range(90)]
    vectors += [(200 + i, [0.5] * 8, 1) for i in range(60)] + [(200, [0.5] * 8, 1), (None, [0.25] * 8, None)]  # copies, repeated rows, a null id
    odd = [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("-inf")] * 8, None)]
    df = spark.createDataFrame([(i, v, c, 1.0, 7, 3, "x") for i, v, c in vectors + odd], VECTORS)
    got = [tuple(r) for r in member_lloyd.compress(df, parts=4, entries=16, rounds=rounds).select(*CODES).collect()]
    want = brute_codes([(i, [math.floor(256 * x) for x in v], c) for i, v, c in vectors], 4, 16, rounds)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_codes_of_few_rows_empty_tables_and_refused_vectors(spark):
    df = spark.createDataFrame([(1, [1.0] * 16, 1, 1.0, 7, 3, "x"), (2, [-1.0] * 16, 1, 1.0, 7, 3, "x")], VECTORS)
    assert [r["code"] for r in member_lloyd.compress(df).orderBy("vec_id").collect()] == ["00" * 16, "01" * 16]
    assert member_lloyd.compress(df.filter("false")).columns == list(CODES)
    assert member_lloyd.compress(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        member_lloyd.compress(df.withColumn("embedding", F.slice("embedding", 1, F.col("vec_id").cast("int"))))


def test_owners_add_up_without_an_exchange(spark):
    members = member_lloyd._Members(spark, 4)
    name = members.put(spark.range(100).selectExpr("cast(id % 2 as int) position", "cast(id % 5 as int) entry", "0 salt", "id x0").repartition(4, "position", "entry", "salt"))
    with member_lloyd._owners_kept(spark):
        own = spark.table(name).groupBy("position", "entry", "salt").agg(F.sum("x0"))
        assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
        total = member_lloyd.sums([spark.table(name)], 1)
        assert {(r["position"], r["entry"]): (r["n"], r["x0"]) for r in total.collect()}[0, 0] == (10, sum(range(0, 100, 10)))
    members.drop(name)
    assert not spark.catalog.tableExists(name)


def test_nearest_is_exact_for_large_integers():
    book = np.array([[1 << 23, 0], [(1 << 23) + 1, 0], [(1 << 23) + 1, 0]])
    at, far = member_lloyd.nearest(np.array([[(1 << 23) + 1, 0], [-(1 << 23), 1]]), book)
    assert at.tolist() == [1, 0] and far.tolist() == [0, (1 << 24) ** 2 + 1]


# ------------------------------------------------------------------ importance resampling

RESAMPLED = ("doc_id", "n_features", "weight", "score", "rank")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, percent=5, least=20):
    docs = [(i, *brute_features(t)) for i, t in docs]
    s, t = [0] * 10_000, [0] * 10_000
    for _, _, f in docs:
        for b in f:
            s[b] += 1
    for text in target:
        for b in brute_features(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10_000) / ((x + 1) * (sum(t) + 10_000)))) for x, y in zip(s, t)]
    rows = []
    for i, n, f in docs:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_resampling_equals_brute_force_on_the_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = queries.QUERIES["op13_importance_resampling"](spark, SF)
    assert in_order(map(tuple, got.collect())) == in_order(brute_resample(docs, [r["text"] for r in table(spark, SF, "benchmark").collect()]))
    assert got.dtypes == [(c, "bigint") for c in RESAMPLED]


def test_resampling_with_equal_keys_nulls_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(importance, "RUN_ROWS", 8)
    monkeypatch.setattr(importance, "POSITIONS", 4)
    long = " ".join(f"Word{i % 977}-of" for i in range(60_000)) + " " + "w" * 70_000
    text = " ".join(f"token{i} number" for i in range(15))
    docs = [(i, text + f" {i % 7}") for i in range(120)] + [(7, text)] * 60 + [(None, text)] * 60  # a third of the keys are equal, a third of the ids null
    docs += [(1000, long), (1001, None), (1002, ""), (1003, "é" * 30 + " \x00\x7f 日本 語")]
    df = spark.createDataFrame([(i, t, "en", 1, 2, 3) for i, t in docs], "doc_id long, text string, rank string, place int, segment int, id int").repartition(5)
    target = spark.createDataFrame([("token3 number token4",), (None,), ("",)], "text string")
    got = in_order(tuple(r) for r in importance.resample(df, target, percent=60).select(*RESAMPLED).collect())
    assert got == in_order(brute_resample(docs, ["token3 number token4", None, ""], percent=60))


def test_resampling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c"), (2, " ".join("x" * 25))], "doc_id long, text string")
    assert importance.resample(empty, some).count() == 0
    got = importance.resample(some, empty, percent=100).orderBy("doc_id").collect()
    assert [r["rank"] for r in got] == [None, 1] and [r["n_features"] for r in got] == [6, 72]


def test_feature_hashes_are_those_of_the_joined_words():
    texts = ["", None, "A b  c\x00d é—x İstanbul ÄB", "x" * 63 + " " + "y" * 64 + " " + "z" * 65 + " q " + "w" * 70_000 + " tail", " lead", "1-2_3", "日本 語"]
    count, found = importance.Hasher().of(pa.array(texts, pa.string()))
    edge = np.concatenate([[0], np.cumsum(count)])
    for i, text in enumerate(texts):
        n, want = brute_features(text)
        assert count[i] == n and sorted(b for at, bucket in found for a, b in zip(at, bucket) if edge[i] <= a < edge[i + 1]) == sorted(want)


def test_only_segments_of_the_draw_are_ranked(spark):
    rows = spark.range(5000).selectExpr("(id * 7919) % 5003 as a", "id as b").repartition(6).cache()
    for most in (0, 1, 777, 5000):
        got = importance.first_ranks(rows, ["a", "b"], most, 5000).collect()
        want = {k: n + 1 for n, k in enumerate(sorted((r["a"], r["b"]) for r in rows.collect())[:most])}
        assert len(got) == 5000 and all(r["rank"] == want.get((r["a"], r["b"])) for r in got)
