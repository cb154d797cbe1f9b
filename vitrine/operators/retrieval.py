"""BM25 ranking of texts or listing rows against questions.

`bm25` scores all texts for one question: every document counts the words on its own and one small
aggregate gives the collection's figures, without a shuffle of words or documents. Many questions, or
a collection that grows, go to a stored index (`operators.textindex`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import tokens

K1, B = 1.5, 0.75
ABSENT = "N/A"


def render(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """Rows as texts 'col: value col: value'; empty values are left out."""
    parts = [
        F.when(F.col(c).cast("string") != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string")))
        for c in columns
    ]
    return df.select(*keep, F.concat_ws(" ", *parts).alias("text"))


def doc_lengths(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(doc_id, F.size(tokens(F.col(text))).alias("length"))


def postings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted index `(token, doc_id, tf)`."""
    return (
        docs.select(doc_id, F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token", doc_id).agg(F.count(F.lit(1)).alias("tf"))
    )


def document_frequencies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return postings(docs, doc_id, text).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def idf(total: Column, containing: Column) -> Column:
    return F.ln((total - containing + 0.5) / (containing + 0.5) + 1)


def weight(tf: Column, length: Column, average: Column, k1: float, b: float) -> Column:
    share = F.coalesce(F.try_divide(length, average), F.lit(0.0))
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * share))


def words(question: str) -> list[str]:
    """Lower-case words of one question, in order, repeated words kept."""
    return question.lower().split()


def counts(docs: DataFrame, question: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, the number of words, and how often each different word of the question stands there."""
    distinct = list(dict.fromkeys(words(question)))
    return docs.select(doc_id, tokens(F.col(text)).alias("_t")).select(
        doc_id,
        F.size("_t").alias("_len"),
        *[
            (F.size("_t") - F.size(F.array_remove("_t", word))).alias(f"_tf{i}")
            for i, word in enumerate(distinct)
        ],
    )


def scores(counted: DataFrame, question: str, doc_id: str = "doc_id", k1: float = K1, b: float = B) -> DataFrame:
    """`(doc_id, score)` from the `counts` of a question, which are read twice: store them where counting is dear."""
    asked = words(question)
    distinct = list(dict.fromkeys(asked))
    figures = counted.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.avg("_len").alias("average"),
        *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(distinct))],
    ).alias("f")).scalar()
    score = F.lit(0.0)
    for i, word in enumerate(distinct):
        part = idf(figures["n"], figures[f"df{i}"]) * weight(
            F.col(f"_tf{i}"), F.col("_len"), figures["average"], k1, b
        )
        score = score + asked.count(word) * part
    return counted.select(doc_id, score.alias("score"))


def bm25(
    docs: DataFrame, question: str, doc_id: str = "doc_id", text: str = "text",
    k1: float = K1, b: float = B,
) -> DataFrame:
    """`(doc_id, score)` of every document. A repeated word of the question counts again; a word
    no document holds adds nothing."""
    return scores(counts(docs, question, doc_id, text), question, doc_id, k1, b)


def top_k(scores: DataFrame, k: int, doc_id: str = "doc_id") -> DataFrame:
    """The k best documents with a score above 0, equal scores in document order; if nothing
    scores, the first k documents with score 0."""
    best = scores.orderBy(F.desc("score"), doc_id).limit(k)
    highest = F.max("score").over(Window.partitionBy(F.lit(0)))  # over k rows only
    return best.withColumn("_top", highest).where(
        (F.col("score") > 0) | (F.col("_top") <= 0)
    ).drop("_top")


def rows(ranked: DataFrame, table: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Ranked ids with their rows. `ranked` is short, so the table is filtered, not shuffled."""
    return table.join(ranked, doc_id, "inner")


def row_text(columns: Sequence[str]) -> Column:
    lines = [
        F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)), F.lit("\n"))
        for c in columns
    ]
    return F.concat(*lines)


def context(
    found: DataFrame, columns: Sequence[str], doc_id: str = "doc_id",
    best: int = 5, width: int = 8,
) -> DataFrame:
    """Text of the best rows, each as its first columns, best first: one row, one text."""
    shown = found.orderBy(F.desc("score"), doc_id).limit(best)
    text = row_text(list(columns)[:width])
    numbered = shown.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col(doc_id), text.alias("t"))))
        .alias("r")
    )
    blocks = F.transform("r", lambda row, i: F.concat(
        F.lit("--- Dado "), (i + 1).cast("string"), F.lit(" ---\n"), row["t"], F.lit("\n")
    ))
    return numbered.select(F.concat(
        F.lit("Dados do CSV relevantes para a pergunta:\n\n"), F.array_join(blocks, "")
    ).alias("context"))


def _first_rows(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int, head: str, indent: str):
    pieces = [
        F.concat(F.lit(f"{indent}{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)), F.lit("\n"))
        for c in columns
    ]
    first = df.orderBy(*order).limit(n).agg(
        F.array_sort(F.collect_list(F.struct(*order, F.concat(*pieces).alias("_text")))).alias("r")
    )
    start, end = head.split("#")
    return first.select(F.array_join(F.transform("r", lambda row, i: F.concat(
        F.lit(start), (i + 1).cast("string"), F.lit(end), row["_text"]
    )), "")).scalar()


def overview(df: DataFrame, order: Sequence[str], best: int = 5, width: int = 8) -> DataFrame:
    """Context text when nothing was retrieved: size, columns and the first rows."""
    shown = _first_rows(df, df.columns[:width], order, best, "\n--- Registro # ---\n", "")
    return df.agg(F.concat(
        F.lit("Resumo dos dados do CSV:\nTotal de registros: "), F.count(F.lit(1)).cast("string"),
        F.lit("\nColunas: " + ", ".join(df.columns) + "\n\nPrimeiros registros:\n"),
        shown,
    ).alias("context"))


def summary(df: DataFrame, order: Sequence[str], first: int = 3, width: int = 5) -> DataFrame:
    """Corpus summary as one text: rows, columns, main column, first rows."""
    shown = _first_rows(df, df.columns[:width], order, first, "\nRegistro #:\n", "  ")
    return df.agg(F.concat(
        F.lit("RESUMO DO CSV:\n- Total de linhas: "), F.count(F.lit(1)).cast("string"),
        F.lit(f"\n- Colunas: {len(df.columns)}\n- Coluna principal: {df.columns[0]}\n\nDados:\n"),
        shown,
    ).alias("summary"))
