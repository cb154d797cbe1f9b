"""A small labelled table of addresses, the input that the URL filter is trained on.

An address is to be blocked for the subject that its host names. Every other part (subdomain, domain,
language, path) is drawn alike for both labels, and names without a meaning are not blocked, so what
is learned is the subject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Subjects of hosts that are not wanted.
BLOCKED = """casino poker jackpot slots betting bingo roulette pills viagra pharmacy diet steroids payday loans
cash-advance xxx porn escort adult-cams hookup replica warez crack keygen torrent lottery forex-profit
get-rich miracle-cure cheap-meds""".split()
#: Subjects of ordinary hosts.
ALLOWED = """news weather library museum school university science history recipes garden travel maps music film
books sports football chess health hospital bakery coffee wine fashion furniture bicycle railway airport city
council parish charity nature birds fishing sailing hiking photo design code docs wiki forum blog shop market
bank insurance energy water housing jobs""".split()
BESIDE = "win top best my online free big world club go net plus daily home first old".split()
FRONT = ["", "www.", "m.", "blog.", "en.", "shop."]
DOMAINS = ["example.com", "example.net", "example.org", "com", "net", "org", "de", "fr", "es"]
PATHS = ["/en/", "/de/", "/fr/", "/es/", "/", "/a/", "/p/", "/2024/"]
#: One blocked address to so many others.
OTHERS = 4
ROWS = 3_600


def table(spark: SparkSession, rows: int = ROWS, seed: int = 0) -> DataFrame:
    """`url, blocked` of `rows` addresses; another seed draws other ones."""
    def pick(values: list[str], what: int) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "id"), F.lit(len(values))).cast("int"))

    def draw(what: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "id"), F.lit(n))

    blocked = F.col("id") % (OTHERS + 1) == 0
    letters = F.translate(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string"))), 1, 6), "0123456789", "thnrsioule")
    ordinary = F.when(draw(1, 2) == 0, pick(ALLOWED, 2)).otherwise(letters)
    subject = F.when(blocked, pick(BLOCKED, 3)).otherwise(ordinary)
    name = (F.when(draw(4, 3) == 0, F.concat(pick(BESIDE, 5), F.lit("-"), subject))
            .when(draw(4, 3) == 1, F.concat(subject, F.lit("-"), pick(BESIDE, 6))).otherwise(subject))
    url = F.concat(F.lit("https://"), pick(FRONT, 7), name, F.lit("."), pick(DOMAINS, 8), pick(PATHS, 9), draw(10, 100_000).cast("string"))
    return spark.range(rows).select(url.alias("url"), blocked.alias("blocked"))
