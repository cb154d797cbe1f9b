"""First match (prefix or containment) against a dictionary table of any size.

A text that holds a name holds every run of GRAM characters of it. So each name is filed under one of
its runs, the one that fewest names have, and a text asks for its own runs: as many as it has characters,
however many names there are and however long they are. What meets is verified. No pair of a text and a
name without a run in common is ever formed. Distinct texts are matched, not rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup_join

GRAM = 4


def _characters(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0))


def _runs(characters: Column, length: Column, contained: bool) -> Column:
    """The different runs of a length in the characters of a text; only the first one of it for prefixes."""
    starts = F.sequence(F.lit(1), F.size(characters) - length + 1) if contained else F.array(F.lit(1))
    return F.array_distinct(F.transform(starts, lambda at: F.array_join(F.slice(characters, at, length), "")))


def filed(names: DataFrame, contained: bool, gram: int = GRAM) -> DataFrame:
    """`_run, _name, _entry`: each name under its rarest run; a shorter name under itself."""
    entries = names.select(
        F.lower("name").alias("_name"),
        F.struct("priority", *[c for c in names.columns if c != "priority"]).alias("_entry"),
    ).where(F.col("_name").isNotNull())
    size = F.least(F.length("_name"), F.lit(gram))
    cut = entries.select("_name").distinct().select("_name", size.alias("_n"), F.explode(F.array(_characters(F.col("_name")))).alias("_c"))
    runs = cut.select("_name", F.explode(_runs(F.col("_c"), F.col("_n"), contained)).alias("_run"))
    rarity = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_names"))
    chosen = runs.join(rarity, "_run").groupBy("_name").agg(F.min(F.struct("_names", "_run"))["_run"].alias("_run"))
    return entries.join(chosen, "_name")


#: A text travels under two hashes of it, not with its runs.
KEYS = ["_key0", "_key1"]


def _keyed(texts: DataFrame, text: str) -> DataFrame:
    distinct = texts.select(text).where(F.col(text).isNotNull()).distinct()
    return distinct.select(text, *[F.xxhash64(F.lit(i), F.col(text)).alias(k) for i, k in enumerate(KEYS)])


def candidates(keyed: DataFrame, text: str, names: DataFrame, contained: bool = False, gram: int = GRAM) -> DataFrame:
    """`_key0, _key1, _name, _entry` of the texts `(text, _key0, _key1)` and the names filed under a run of theirs."""
    # At most `gram` lengths of runs (and an empty name).
    lengths = names.select(F.sort_array(F.collect_set(F.least(F.length("name"), F.lit(gram)))).alias("n")).scalar()
    folded = F.lower(F.col(text))
    # Cut into characters once: a position in a string costs a walk to it.
    cut = keyed.select(*KEYS, F.explode(F.array(_characters(folded if contained else F.substring(folded, 1, gram)))).alias("_c"))
    asked = (
        cut.withColumn("_n", F.explode(lengths)).where(F.size("_c") >= F.col("_n"))
        .select(*KEYS, F.explode(_runs(F.col("_c"), F.col("_n"), contained)).alias("_run"))
    )
    return asked.join(filed(names, contained, gram), "_run").drop("_run")


def matches(texts: DataFrame, text: str, names: DataFrame, contained: bool = False, gram: int = GRAM) -> DataFrame:
    """`(text, entry)`: for each distinct text the matching entry of lowest priority.

    `names` holds `name`, `priority` and any payload; `entry` is that row as a struct.
    """
    keyed = _keyed(texts, text)
    pairs = candidates(keyed, text, names, contained, gram)
    # A name no longer than a run is the run itself; a longer one is looked for in the text.
    short = pairs.where(F.length("_name") <= gram).groupBy(*KEYS).agg(F.min("_entry").alias("_entry"))
    folded = F.lower(F.col(text))
    holds = F.contains(folded, F.col("_name")) if contained else F.startswith(folded, F.col("_name"))
    long = pairs.where(F.length("_name") > gram).join(keyed, KEYS).where(holds).select(*KEYS, "_entry")
    found = short.unionByName(long).groupBy(*KEYS).agg(F.min("_entry").alias("entry"))
    return found.join(keyed, KEYS).select(text, "entry")


def first_match(
    df: DataFrame, text: str, names: DataFrame, contained: bool = False,
) -> DataFrame:
    """Rows with an added `entry` struct, null where nothing matches."""
    found = matches(df, text, names, contained)
    return lookup_join(df, found, [text])
