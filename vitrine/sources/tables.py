"""The demonstration tables as listings.

`listing_base` reads order lines, parts, suppliers and nations as listings with known values;
`cards` renders them to the raw text a collection run would deliver, with faults mixed in. A
parse of the cards must give the known values back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# City and state of a nation, by key modulo 5.
PLACES = [
    ("São Paulo", "SP"), ("Belo Horizonte", "MG"), ("Cotia", "SP"),
    ("São José do Rio Preto", "SP"), ("Campinas", "SP"),
]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Setting that spreads the demonstration tables: their files have too few splits for several cores.
SPLITS = "vitrine.demonstration.splits"


def spread(df: DataFrame) -> DataFrame:
    """The rows in as many partitions as the session asks for (`local_session` does); untouched
    without the setting, as on a cluster, where a large table has its own splits."""
    wanted = df.sparkSession.conf.get(SPLITS, None)
    return df.repartition(int(wanted)) if wanted else df


def _pick(index: Column, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def listing_base(spark: SparkSession, folder: str) -> DataFrame:
    """One listing per order line. The dimension sides are joined as their sizes suggest."""
    lines = spread(
        table(spark, folder, "lineitem").select(*KEY, "l_extendedprice", "l_shipdate")
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    made = F.year("l_shipdate")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .select(
            *KEY,
            (order * 8 + line).alias("id"),
            F.col("p_brand").alias("marca"),
            F.col("p_name").alias("nome"),
            F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("versao"),
            F.col("l_extendedprice").alias("preco"),
            ((part * 7919 + order * 31 + line) % 160000).alias("km"),
            made.alias("ano_fabricacao"),
            (made + line % 2).alias("ano_modelo"),
            _pick(F.col("n_nationkey") % 5, [city for city, _ in PLACES]).alias("cidade"),
            _pick(F.col("n_nationkey") % 5, [state for _, state in PLACES]).alias("uf"),
            "n_nationkey", "n_name", "s_name",
            F.when(line % 2 == 0, F.lit("Sim")).otherwise(F.lit("Não")).alias("compra_online"),
            ((order * 31 + part * 7 + line) % 50).cast("int").alias("cls"),
            "l_shipdate",
        )
    )


def thousands(number: Column) -> Column:
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))


def money_text(number: Column) -> Column:
    return F.concat(F.lit("R$ "), F.translate(F.format_number(number, 2), ".,", ",."))


def cards(base: DataFrame) -> DataFrame:
    """Listings as card lines. Class 0 has two lines, 1 three lines, 2 no price, 3 no years,
    4 no title; all others are whole."""
    kind = F.col("cls")
    title = F.when(kind == 4, F.lit("")).otherwise(F.concat_ws(" ", "marca", "nome"))
    years = F.when(kind == 3, F.lit("sem ano")).otherwise(
        F.concat_ws("/", F.col("ano_fabricacao").cast("string"), F.col("ano_modelo").cast("string"))
    )
    info = F.concat(
        years, F.lit(" • "), thousands(F.col("km")), F.lit(" KM • "),
        F.col("cidade"), F.lit(", "), F.col("uf"),
    )
    price = F.when(kind == 2, F.lit("Consulte")).otherwise(money_text(F.col("preco")))
    terms = F.concat(
        F.lit("Entrada + parcelas a partir de R$ "), (F.col("km") % 900 + 100).cast("string"),
        F.lit("*"),
    )
    flag = F.concat(F.lit("COMPRA_ONLINE: "), F.col("compra_online"))
    whole = F.array(title, F.col("versao"), info, price, terms, flag)
    kept = F.when(kind == 0, 2).when(kind == 1, 3).otherwise(6)
    # As a generated row the text is rendered once; a plain projection would be rendered again
    # inside every filter that Catalyst pushes below it.
    return base.select(
        *KEY, "id",
        F.col("marca").alias("source"),
        F.col("l_orderkey").alias("position"),
        "l_shipdate",
        F.explode(F.array(F.slice(whole, F.lit(1), kept))).alias("lines"),
    )


def listing_cards(spark: SparkSession, folder: str) -> DataFrame:
    return cards(listing_base(spark, folder))
