"""Quality rules: a decision list learned by sequential covering.

Statistics of a text are built-in expressions. The list is learned on a bounded sample of labelled
rows: each rule is grown by adding the threshold with the best gain, seen in a small histogram per
feature, and pruned on rows kept apart. The outcome is one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import SPACES, WORD, staged, words, written

#: Labelled rows that the list is learned from: the bound of the sample.
SAMPLE_ROWS = 8_000
SYMBOLS = r"[#*$%&|<>]"
FEATURES = ("n_words", "word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "mark_ratio")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Threshold:
    feature: str
    above: bool
    value: float

    def column(self) -> Column:
        name = F.col(self.feature)
        return name >= F.lit(self.value) if self.above else name < F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.value:.6g}"


Rule = tuple[Threshold, ...]


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns and the statistics of each text, one row per row.

    Words are separated by space and the controls 9 to 13; a null text has none and all counts are
    zero. `n_repeat_words` counts words inside 3-word windows that occur twice or more in the text:
    each window is its whole 64-bit hash and its position, so equal windows are neighbours after one
    sort, and a text of any length stays within its row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], text.alias("_text"))
    df = staged(df, _words=words(F.col("_text")), _lines=F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
    n = F.size("_words")
    df = df.select(
        *[f"_k{i}" for i in range(len(keep))], "_words", n.cast("long").alias("n_words"),
        (F.length("_text") - F.regexp_count("_text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("_upper"),
        F.regexp_count("_text", F.lit(r"[!?]")).cast("long").alias("_marks"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    windows = F.expr("""transform(if(n_words > 2, sequence(0, cast(n_words as int) - 3), cast(array() as array<int>)),
        i -> struct(xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)) as h, cast(i as long) as p))""")
    df = staged(df, _sorted=F.sort_array(windows)).drop("_words")
    hits = F.expr("""filter(_sorted, (x, i) -> x.h <=> get(_sorted, i - 1).h or x.h <=> get(_sorted, i + 1).h)""")
    df = staged(df, _hits=F.sort_array(F.transform(hits, lambda x: x["p"])))
    covered = F.expr("""aggregate(transform(_hits, (p, i) -> if(i = 0, 3L, least(3L, p - get(_hits, i - 1)))),
        0L, (total, x) -> total + x)""")
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    return df.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *BASE[:-1], covered.alias("n_repeat_words"),
        (F.col("word_chars") / n_words).alias("word_length"), (F.col("n_symbols") / n_words).alias("symbol_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))).alias("dup_line_ratio"),
        (covered / n_words).alias("repeat_ratio"),
        (F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("upper_ratio"),
        (F.col("_marks") / n_words).alias("mark_ratio"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_statistics(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        label_col: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and `bad` (label 0) of at most `rows` labelled documents that pass the base
    rules, as a written table.

    The sample is the labelled identifiers with the smallest hashes, so it repeats. Null
    identifiers and labels are left out; a document labelled twice is bad if any label says so.
    """
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("_label_id")).agg((F.min(label_col) == 0).alias("bad"))
    sample = marked.orderBy(F.xxhash64("_label_id"), "_label_id").limit(rows)
    # The sample has a fixed largest size (identifier and flag of SAMPLE_ROWS rows).
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")).join(
        F.broadcast(sample), F.col("_id") == F.col("_label_id"))
    counted = statistics(chosen, "_body", ("_id", "bad")).where(~base_failed())
    return written(counted.select("_id", "bad", *FEATURES), "labelled")


def cut_points(table: DataFrame, bins: int = 24) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: quantiles of all rows and of the bad ones."""
    probabilities = [i / bins for i in range(1, bins)]
    row = table.agg(*[
        F.percentile_approx(F.when(bad, F.col(f)) if bad is not None else F.col(f), probabilities, 1000).alias(f"{f}_{i}")
        for f in FEATURES for i, bad in enumerate((None, F.col("bad")))
    ]).first()
    return {f: sorted({v for i in (0, 1) for v in (row[f"{f}_{i}"] or [])}) for f in FEATURES}


def _matches(rule: Rule) -> Column:
    out = F.lit(True)
    for threshold in rule:
        out = out & threshold.column()
    return out


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) rows by feature and bin; at most features x bins rows reach the driver."""
    def bin_of(feature: str) -> Column:
        points = F.array(*[F.lit(float(v)) for v in cuts[feature]])
        return F.size(F.filter(points, lambda v: v <= F.col(feature)))

    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in FEATURES if cuts[f]])
    counted = rows.select("bad", F.explode(pairs).alias("x")).groupBy("x.feature", "x.bin").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counted.collect()}


def _best(histogram, cuts, least_bad: int) -> tuple[float, Threshold | None]:
    """The threshold with the greatest gain in information about bad rows."""
    best: tuple[float, Threshold | None] = (0.0, None)
    for feature, points in cuts.items():
        bins = [histogram.get((feature, i), (0, 0)) for i in range(len(points) + 1)]
        bad, good = sum(b for b, _ in bins), sum(g for _, g in bins)
        if not bad:
            continue
        before = math.log2(bad / (bad + good))
        low_bad = low_good = 0
        for i, value in enumerate(points):
            low_bad, low_good = low_bad + bins[i][0], low_good + bins[i][1]
            for above, b, g in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                if b >= least_bad and b + g < bad + good:
                    gain = b * (math.log2(b / (b + g)) - before)
                    if gain > best[0] + 1e-9:
                        best = (gain, Threshold(feature, above, value))
    return best


def learn(table: DataFrame, max_rules: int = 8, max_conditions: int = 3, least_bad: int = 8,
          least_precision: float = 0.97) -> list[Rule]:
    """An ordered list of rules that name bad rows; empty if nothing can be learned.

    Two rows of three grow a rule, the third prunes it: of all its beginnings that with the best
    (bad - good) / (bad + good) stays. A rule below `least_precision` on the pruning rows ends the
    list: good documents are worth more than the last bad ones.
    """
    cuts = cut_points(table)
    if not any(cuts.values()):
        return []
    rest = table.withColumn("_grow", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(3)) < 2)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule: Rule = ()
        while len(rule) < max_conditions:
            histogram = _histogram(rest.where(F.col("_grow") & _matches(rule)), cuts)
            _, threshold = _best(histogram, cuts, least_bad)
            if threshold is None:
                break
            rule = (*rule, threshold)
        if not rule:
            break
        counts = rest.where(~F.col("_grow")).agg(*[
            F.count_if(_matches(rule[: k + 1]) & (F.col("bad") == bad)).alias(f"{'b' if bad else 'g'}{k}")
            for k in range(len(rule)) for bad in (True, False)]).first()
        worth = [((counts[f"b{k}"] - counts[f"g{k}"]) / max(1, counts[f"b{k}"] + counts[f"g{k}"]), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        bad, good = counts[f"b{k}"], counts[f"g{k}"]
        if not bad or bad / (bad + good) < least_precision:
            break
        rules.append(rule[: k + 1])
        rest = rest.where(~_matches(rule[: k + 1]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The first rule that a row meets, as text; null if none."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_matches(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row's `keep` columns, base statistics, `base_failed`, the `rule` met and `kept`.

    Rows with null columns stay; a null or empty text fails the base rules. Columns beside `keep`
    are not read, so their names cannot clash.
    """
    counted = statistics(docs, text_col, keep)
    rule = F.when(~base_failed(), verdict(rules))
    out = counted.select(*keep, *BASE, base_failed().alias("base_failed"), rule.alias("rule"))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
