import random
import re
from itertools import permutations

from pyspark.sql import functions as F
from texts import documents, prose  # noqa: F401

from vitrine.llm import catalog, filter_audit

COLUMNS = ["part", "filter_order", "step", *filter_audit._LONGS]


def plain(docs, labels):
    """Every order over every document, one after another."""
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = {}
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
               "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first[text] < i}
        parts.setdefault(source or "", []).append(({k for k, v in bad.items() if v}, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        shares = dict.fromkeys("ABCDE", 0)
        made = []
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                shares[name] += len(gone)
                made.append(["".join(order), step, len(left), len(gone), sum(name in r[0] for r in rows) - len(gone),
                             sum(r[0] == {name} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)])
        out += [(part, *m, shares[m[0][m[1] - 1]]) for m in made]
    return sorted(out)


def test_adjacent_swaps_visit_every_order_once():
    for k in range(1, 7):
        order, seen = list(range(k)), {tuple(range(k))}
        for at in filter_audit.adjacent_swaps(k):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert seen == set(permutations(range(k))) and len(filter_audit.adjacent_swaps(k)) == len(seen) - 1


def test_swaps_keep_the_function():
    rng = random.Random(2)
    for k in (1, 2, 3, 5):
        counts = {m: (rng.randint(0, 3), rng.randint(0, 2), 0) for m in range(1 << k) if rng.random() < 0.6} or {0: (1, 0, 0)}
        diagram = filter_audit.Diagram(counts, k)
        for at in [None, *filter_audit.adjacent_swaps(k)]:
            if at is not None:
                diagram.swap(at)
            for mask in range(1 << k):
                node = diagram.root
                for name in diagram.order:
                    node = (diagram.failed if mask >> name & 1 else diagram.passed)[node]
                assert diagram.total[node] == counts.get(mask, (0, 0, 0))
            # Equal subtrees are one node: children name a node of a level only once.
            for level in diagram.levels[:-1]:
                assert len(set(level.values())) == len(level)


def test_equal_subtrees_are_shared():
    counts = {m: (1, 0, 0) for m in range(32)}
    assert len(filter_audit.Diagram(counts, 5).total) == 1 + 1 + 5  # empty, one leaf, one node a level


def test_query_equals_every_order(spark, tmp_path, prose):
    rng = random.Random(8)
    texts = prose(40, 60, seed=5) + ["few words", "", None, "A B C D " * 20, "same same " * 40, "has # mark " + "one two " * 30]
    texts += [t.upper() for t in texts[:5]] + [t + " $" for t in texts[:5]]
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", None, "", "ü"])) for i in range(300)]
    docs += [(i, "copied text " * 30, "hot") for i in range(300, 700)] + docs[:5] + [(None, "copied text " * 30, "s"), (None, None, None), (7, "x" * 2_000_000, "long")]
    labels = [(rng.choice([*range(700), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("mask", F.lit(1)).withColumn("part", F.lit("p")).withColumn("digest", F.lit(0))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(1)).write.parquet(f"{tmp_path}/labels.parquet")
    result = catalog.op13(spark, str(tmp_path))
    assert result.columns == COLUMNS
    assert sorted(tuple(r) for r in result.collect()) == plain(docs, labels)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, frame in (("none", docs.limit(0)), ("some", docs)):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert catalog.op13(spark, f"{tmp_path}/none").count() == 0
    rows = catalog.op13(spark, f"{tmp_path}/some").collect()
    assert len(rows) == 600 and all(r["removed"] == (r["filter_order"][r["step"] - 1] == "A") for r in rows)
