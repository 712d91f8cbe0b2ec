import numpy as np
import pytest

from martloom.llm import hamming


def brute(rows, queries, k):
    rows, out = sorted(set(rows)), []
    for q, code in sorted(set(queries)):
        near = sorted((bin((code ^ c) & (1 << 64) - 1).count("1"), i) for i, c in rows if i != q)
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return out


@pytest.mark.parametrize("shard", [1 << 17, 40, 3])
def test_against_brute_force(spark, shard):
    rng = np.random.default_rng(2)
    codes = rng.integers(-(1 << 62), 1 << 62, 120).tolist()
    codes += [codes[i] ^ (1 << int(rng.integers(64))) for i in range(60)] + [codes[0]] * 40 + [0, -1]
    rows = list(enumerate(codes)) + [(3, codes[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, code long, rank string").repartition(4)
    more = spark.createDataFrame([(None, 5, "x"), (777, None, "x")], df.schema)
    queries = df.where("id % 7 = 0")
    got = hamming.top_k(df.unionByName(more), queries.unionByName(more), 10, shard).collect()
    assert sorted(map(tuple, got)) == brute(rows, [r for r in rows if r[0] % 7 == 0], 10)


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, float("nan")]), (2, None), (3, []), (4, [None, 2.0])]
    df = hamming.sign_codes(spark.createDataFrame(rows, "id long, embedding array<float>"), dims=4)
    assert {r.id: r.code for r in df.collect()} == {1: 0b101, 2: 0, 3: 0, 4: 0b10}
    wide = spark.createDataFrame([(1, [1.0] * 64)], "id long, embedding array<float>")
    assert hamming.sign_codes(wide).first().code == -1


def test_fewer_rows_than_k_and_none(spark):
    df = spark.createDataFrame([(1, 3), (2, 1)], "id long, code long")
    assert sorted(map(tuple, hamming.top_k(df, df, 5).collect())) == [(1, 1, 2, 1), (2, 1, 1, 1)]
    empty = df.where("id < 0")
    assert hamming.top_k(empty, empty).collect() == hamming.top_k(df, empty).collect() == hamming.top_k(empty, df).collect() == []
