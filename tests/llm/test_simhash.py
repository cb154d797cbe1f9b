import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F
from texts import documents, prose  # noqa: F401

from vitrine.llm import simhash
from vitrine.llm.catalog import QUERIES
from vitrine.llm.components import components


def found(df):
    rows = df.select("_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")), "component_id").collect()
    return sorted(map(tuple, rows), key=str)


def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op2_simhash_bk_tree"](spark, folder).collect()))
    assert got == sorted(plain.simhash_components(rows))


def test_edges(documents, prose):
    base = prose(1, 300)[0]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, base), (8, base.upper()), (9, base + " x"),
            (None, base), (7, base), (None, "alone in the text"), (10, "word " * 60_000), (11, "ÄÖ ÄÖ äö"), (12, "a\x0bb\x1cc d")]
    got = found(simhash.near_duplicates(documents(rows)))
    assert got == sorted(plain.simhash_components(rows), key=str)


def test_empty_table_and_clashing_columns(spark, documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    df = documents([(1, "a b c d"), (2, "a b c d")]).withColumn("fp", F.lit(1)).withColumn("_id", F.lit(9)).withColumn("root", F.lit(0))
    assert found(simhash.near_duplicates(df))[0][2] == 1
    assert simhash.keep_one(df).columns == df.columns and simhash.keep_one(df).count() == 1


@pytest.mark.parametrize("tree_nodes", [4, 2_048])
def test_search_in_shards_against_all_pairs(spark, tree_nodes):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(12)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    classes = spark.createDataFrame([(v, [v]) for v in values], "node long, fp array<long>")
    masks = simhash.block_masks(2)
    got = {r["node"]: r["root"] for r in components(simhash.links(classes, 2, masks, tree_nodes)).collect()}
    mask = (1 << 64) - 1
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if ((values[i] ^ values[j]) & mask).bit_count() <= 2]
    root = plain.roots(len(values), pairs)
    assert [got.get(v, v) for v in values] == [values[r] for r in root]


def test_tree_follows_only_edges_within_radius():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, (300, 1), dtype=np.int64).view(np.uint64)
    tree = simhash.Tree(values)
    near = {(n, int(q)) for n, hits in tree.near(values, 20) for q in hits}
    want = {(i, j) for i in range(300) for j in range(300) if simhash.distances(values[i : i + 1], values[j])[0] <= 20}
    assert near == want
    for node, children in enumerate(tree.children):
        for edge, child in children.items():
            assert simhash.distances(values[child : child + 1], values[node])[0] == edge


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    edges = spark.createDataFrame([*pairs, (7, 7), (None, 3)], "a long, b long")
    names = sorted({x for p in pairs for x in p} | {7})
    root = plain.roots(len(names), [(names.index(a), names.index(b)) for a, b in pairs])
    want = {n: names[r] for n, r in zip(names, root)}
    for finish in (10_000, 20, 0):
        assert {r["node"]: r["root"] for r in components(edges, finish).collect()} == want
    assert components(edges.where("a < 0")).count() == 0


def test_keep_one_keeps_the_first_of_each_component(spark, documents, prose, folder):
    texts = prose(40, 200, seed=8, vocabulary=3000)
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(texts)]
    for i, t in enumerate(texts[:20]):
        w = t.split()
        w[rng.randrange(200)] = "changed"
        rows += [(100 + i, " ".join(w)), (200 + i, t), (300 + i, t.encode().upper().decode())]
    rows += [(400, None), (401, ""), (0, texts[0]), (None, texts[3]), (None, "on its own " * 20), (None, "on its own " * 20)]
    rows += [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id + 1000", "text").collect()]
    df = documents(rows)
    named = {(r[0], r[1]): r[2] for r in plain.simhash_components(rows)}
    want = {c for (i, _), c in named.items() if c is not None}
    kept = [r["doc_id"] for r in simhash.keep_one(df).collect()]
    assert sorted(k for k in kept if k is not None) == sorted(want) and kept.count(None) == 1
    assert {i for i in range(40)} <= want and not any(200 <= i < 400 for i in want)


def test_texts_of_one_checksum_are_told_apart(monkeypatch, documents):
    """With the first checksum equal for all texts, the second one still keeps them apart."""
    texts = ["one two three four", "five six seven eight", "nine ten eleven twelve"]
    monkeypatch.setattr(simhash, "row_keys", lambda docs, i, t: docs.select(
        F.col(i).alias("_id"), F.coalesce(F.col(t), F.lit("")).alias("_text"), F.xxhash64(F.lit("")).alias("_sum")))
    real = F.xxhash64
    monkeypatch.setattr(simhash.F, "xxhash64", lambda *c: real(F.lit("")) if len(c) == 1 else real(*c))
    assert simhash.keep_one(documents([(1, t) for t in texts])).count() == 3
