from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from test_joins import without_broadcast

from vitrine.operators import retrieval, textindex
from vitrine.sources import versions


def plain_bm25(texts, question, k1=1.5, b=0.75):
    docs = [t.lower().split() for t in texts]
    average = sum(map(len, docs)) / len(docs)
    scores = [0.0] * len(docs)
    for word in question.lower().split():
        containing = sum(word in d for d in docs)
        if containing:
            rarity = math.log((len(docs) - containing + 0.5) / (containing + 0.5) + 1)
            for i, d in enumerate(docs):
                tf = d.count(word)
                if tf:
                    scores[i] += rarity * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / average))
    return scores


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(5)
    vocabulary = ["gol", "Uno", "SP", "azul", "km", "2020", "ção"] + [f"w{i}" for i in range(30)]
    texts = [draw.choice(["", " ", "\n"]).join([]) + " \n ".join(draw.choices(vocabulary, k=draw.randint(0, 25))) for _ in range(80)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


QUESTIONS = ["gol uno", "GOL gol w3 nada", "azul  ção\tw1 w2 w2", "w9", "nada nunca", ""]


@pytest.mark.parametrize("question", QUESTIONS)
def test_single_question(corpus, question):
    texts, docs = corpus
    got = {r.doc_id: r.score for r in retrieval.bm25(docs, question).collect()}
    for i, score in enumerate(plain_bm25(texts, question)):
        assert got[i] == pytest.approx(score, abs=1e-12)


def ranking(texts, question, k):
    order = sorted(enumerate(plain_bm25(texts, question)), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return [i for i, s in order if s > 0] or [i for i, _ in order]


@pytest.fixture(scope="module")
def index(corpus, tmp_path_factory):
    return textindex.build_index(corpus[1], str(tmp_path_factory.mktemp("index")), buckets=4)


def check_many(rows, texts, questions, k):
    for q, question in enumerate(questions):
        mine = sorted((r.rank, r.doc_id, r.score) for r in rows if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        scores = plain_bm25(texts, question)
        assert [m[2] for m in mine] == pytest.approx([scores[i] for i in ranking(texts, question, k)], abs=1e-9)


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_questions(spark, corpus, index, broadcast):
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id long, text string")
    if broadcast:
        rows = textindex.bm25_many(index, asked, 6).collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, textindex.bm25_many(index, asked, 6, prune=False).collect()))
    else:
        with without_broadcast(spark):
            rows = textindex.bm25_many(index, asked, 6).collect()
    check_many(rows, corpus[0], QUESTIONS, 6)


@pytest.mark.parametrize("question", [QUESTIONS[1], QUESTIONS[4], ""])
def test_index_agrees_with_direct_scores(corpus, index, question):
    direct = retrieval.top_k(retrieval.bm25(corpus[1], question), 7).collect()
    stored = textindex.search(index, question, 7).collect()
    assert sorted(round(r.score, 8) for r in stored) == sorted(round(r.score, 8) for r in direct)
    again = textindex.TextIndex.load(corpus[1].sparkSession, index.root)
    assert sorted(map(tuple, textindex.search(again, question, 7).collect())) == sorted(map(tuple, stored))


def test_a_question_reads_only_the_folders_of_its_words(index):
    plan = index.postings([1, 3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "[bucket").replace("[[bucket", "[bucket")
    files = [r[0] for r in index.postings([1]).select(F.input_file_name()).distinct().collect()]
    assert files and all("/bucket=1/" in f for f in files)


def test_a_common_word_does_not_pair_all(spark, tmp_path, monkeypatch):
    """Every question holds two words that all documents have; few documents are scored for it."""
    monkeypatch.setattr(textindex, "BLOCK", 16)
    monkeypatch.setattr(textindex, "PART", 700)
    draw = random.Random(11)
    rare = [f"r{i}" for i in range(400)]
    texts = [" ".join(["the", "of"] * draw.randint(1, 4) + draw.choices(rare, k=draw.randint(3, 8))) for _ in range(3000)]
    questions = [f"the of {draw.choice(rare)} {draw.choice(rare)} the" for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    index = textindex.build_index(docs, str(tmp_path / "i"), buckets=4)
    assert index.postings().where("token = 'the'").select("part").distinct().count() == 5
    asked = spark.createDataFrame(list(enumerate(questions)), "query_id long, text string")
    scored = textindex.candidates(index, asked, 5).count()
    assert 0 < scored < 0.1 * len(texts) * len(questions)
    check_many(textindex.bm25_many(index, asked, 5).collect(), texts, questions, 5)


def same_index(one, two):
    for name in ("frequencies", "figures"):
        left, right = (sorted(map(tuple, getattr(i, name)().collect())) for i in (one, two))
        assert left == right
    words = [sorted(map(str, i.documents.select("doc_id", "length", "tokens", "tfs").collect())) for i in (one, two)]
    assert words[0] == words[1]


def test_a_grown_index_equals_a_fresh_one(spark, corpus, tmp_path):
    """Documents are added, some with keys that stand already, and deleted; then all is merged."""
    texts = corpus[0]
    first, second = list(enumerate(texts[:50])), [(i % 60, t) for i, t in enumerate(texts[50:], 50)] + [(3, texts[0]), (None, "gol azul")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    gone = [0, 3, 55, 999]
    index = textindex.build_index(frame(first), str(tmp_path / "grown"), buckets=4).add(frame(second))
    index = index.delete(frame([(g, "") for g in gone])).delete(frame([(3, "")]))
    left = [r for r in first + second if r[0] not in gone]
    fresh = textindex.build_index(frame(left), str(tmp_path / "fresh"), buckets=4)
    same_index(index, fresh)
    asked = spark.createDataFrame(list(enumerate(QUESTIONS[:3])), "query_id long, text string")
    want = sorted((r.query_id, r.rank, r.score) for r in textindex.bm25_many(fresh, asked, 6).collect())
    assert sorted((r.query_id, r.rank, r.score) for r in textindex.bm25_many(index, asked, 6).collect()) == want
    merged = index.merge()
    assert len(merged.segments) == 1 and not merged.deletions
    same_index(merged, fresh)
    assert sorted((r.query_id, r.rank, r.score) for r in textindex.bm25_many(merged, asked, 6).collect()) == want


def test_an_unfinished_change_is_not_seen(spark, corpus, tmp_path, monkeypatch):
    root = str(tmp_path / "i")
    index = textindex.build_index(corpus[1], root, buckets=2)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "publish", fails)
    with pytest.raises(RuntimeError):
        index.add(corpus[1])
    assert textindex.TextIndex.load(spark, root).segments == index.segments


def test_replaced_tables_are_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    for n in (3, 5):
        versions.replace(spark.range(n), root)
        assert versions.read(spark, root).count() == n
    kept = versions.current(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            versions.replace(spark.range(9), root)
    assert versions.read(spark, root).count() == 5 and versions.current(spark, root) == kept
    assert len(versions.prune(spark, root, keep=1)) == 2 and versions.read(spark, root).count() == 5
    assert versions.replace(spark.range(1), root) and versions.read(spark, root).count() == 1


def test_top_k_and_fallback(corpus):
    texts, docs = corpus
    best = retrieval.top_k(retrieval.bm25(docs, "gol w3"), 5).collect()
    assert sorted(r.doc_id for r in best) == sorted(ranking(texts, "gol w3", 5))
    none = retrieval.top_k(retrieval.bm25(docs, "nada"), 5).collect()
    assert sorted((r.doc_id, r.score) for r in none) == [(i, 0.0) for i in range(5)]


def test_render_context_and_summary(spark):
    rows = spark.createDataFrame([(1, "Fiat", "", None), (2, "VW", "Gol", 2020)], "id int, marca string, modelo string, ano int")
    texts = [r.text for r in retrieval.render(rows, rows.columns).orderBy("id").collect()]
    assert texts == ["id: 1 marca: Fiat", "id: 2 marca: VW modelo: Gol ano: 2020"]
    ranked = spark.createDataFrame([(2, 1.5), (1, 0.5)], "id int, score double")
    found = retrieval.rows(ranked, rows, "id")
    text = retrieval.context(found, ["id", "marca", "ano"], "id").collect()[0].context
    assert text == (
        "Dados do CSV relevantes para a pergunta:\n\n"
        "--- Dado 1 ---\nid: 2\nmarca: VW\nano: 2020\n\n--- Dado 2 ---\nid: 1\nmarca: Fiat\nano: N/A\n\n"
    )
    summary = retrieval.summary(rows, ["id"]).collect()[0].summary
    assert "- Total de linhas: 2\n- Colunas: 4\n- Coluna principal: id\n" in summary
    assert "\nRegistro 2:\n  id: 2\n  marca: VW\n  modelo: Gol\n  ano: 2020\n" in summary
    assert "Total de registros: 2\n" in retrieval.overview(rows, ["id"]).collect()[0].context


def test_row_ranking_stores_counts_and_deals_out_nothing(spark, folder):
    """One question over the listings: no index is built, and what is ranked holds counts, not texts."""
    from vitrine.plans.catalog import QUERIES

    ranked = QUERIES["q_bm25_rows"](spark, folder)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "hashpartitioning" not in plan and ranked.count() == 10


def test_scores_from_stored_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b b"), (3, None), (1, "c")], "doc_id long, text string")
    counted = spark.createDataFrame(retrieval.counts(docs, "b a b").collect())
    assert sorted(map(tuple, retrieval.scores(counted, "b a b").collect())) == sorted(map(tuple, retrieval.bm25(docs, "b a b").collect()))


def test_many_hits_leave_only_what_can_win(spark, tmp_path):
    """All documents hold the words asked: of the pairs with questions, few are left after the scan, and none of the best is lost."""
    texts = [" ".join(["the"] * (i % 7 + 1) + ["of"] * (i % 5 + 1) + ["x"] * (i % 11)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = textindex.build_index(docs, str(tmp_path / "i"), buckets=2)
    asked = spark.createDataFrame([(0, "the of"), (1, "of of"), (2, "the")], "query_id long, text string")
    ask = textindex._ask(index, asked, 1.5, 0.75, None)
    judged = textindex._judged(ask, 5)
    assert textindex._scan_is_less(ask, textindex._needed(ask, judged))
    assert 15 <= ask.scanned(judged.select("query_id", "least").distinct()).count() < 0.2 * 3 * len(texts)
    check_many(textindex.bm25_many(index, asked, 5, prune=False).collect(), texts, ["the of", "of of", "the"], 5)
