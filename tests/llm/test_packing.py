import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from vitrine.llm import packing


def plain_best_fit(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= size
                and (source is None or b["sources"][source] < per_source) and (cluster is None or cluster not in b["clusters"])]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"room": capacity, "sources": Counter(), "clusters": set()})
        bins[at]["room"] -= size
        bins[at]["sources"][source] += 1
        bins[at]["clusters"].add(cluster)
        out.append(at)
    return out


def test_against_brute_force():
    for seed in range(30):
        rng = random.Random(seed)
        n = rng.randint(0, 120)
        sizes = [rng.randint(0, 60) for _ in range(n)]
        if seed % 2:
            sizes.sort(reverse=True)
        sources = [rng.choice(["a", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.choice([1, 2, 3, 4, 5, None, i + 10]) for i in range(n)]
        for per_source in (1, 3):
            assert packing.best_fit(sizes, sources, clusters, 60, per_source) == plain_best_fit(sizes, sources, clusters, 60, per_source)


def test_table(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 5, 40, 90, 100, 101, 250, None]), rng.choice(["hot", "hot", "b", None]), rng.choice([1, 2, i, None])) for i in range(900)]
    rows += [(None, 30, "b", None), (5, rows[5][1], rows[5][2], rows[5][3]), (901, 100_000, "x", 3)]
    df = spark.createDataFrame(rows, "id long, n long, source string, cluster long").withColumn("bin", F.lit("x")).withColumn("shard", F.lit(1))
    out = packing.pack(df, "id", F.col("n"), F.col("source"), F.col("cluster"), capacity=100, per_source=2, shard_pieces=64).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        bins[r["bin"]].append(r)
        pieces[r["_id"]].append((r["piece"], r["first_unit"], r["size"]))
    for held in bins.values():
        assert sum(r["size"] for r in held) <= 100 and sorted(r["slot"] for r in held) == list(range(len(held)))
        assert all(n <= 2 for s, n in Counter(r["source"] for r in held).items() if s is not None)
        assert all(n == 1 for c, n in Counter(r["cluster"] for r in held).items() if c is not None)
    want = defaultdict(list)
    for i, n, _, _ in rows:
        n = n or 0
        want[i] += [(p, 100 * p, min(100, n - 100 * p)) for p in range(max(1, -(-n // 100)))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    empty = packing.pack(df.limit(0), "id", F.col("n"), F.col("source"), F.col("cluster"))
    assert empty.count() == 0
