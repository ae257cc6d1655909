"""URL filter: rules by host and path, and a logistic regression for the rest.

The regression sees hashed character n-grams of the host and the path and is trained by Spark from the
labelled addresses below. Splitting, rules, hashing and scoring are DataFrame expressions.

The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
follows up to ``?``, ``#`` or the end. A null address or one without ``://`` has an empty host and path.
A rule ``host/path`` fits its host and all subdomains of it if the path starts with the rule's; the
longest fitting rule decides, and of equally long ones the first. Repeated rows are judged each on its
own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (rule, verdict)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: Small table of labelled addresses: made-up hosts of ordinary and unwanted sites.
ALLOWED = """
    https://news.example.com/en/2024/05/election-results http://blog.example.net/en/4312
    https://www.example.com/articles/history-of-bread https://docs.example.net/guide/install
    https://library.example.edu/catalog/book/9912 https://example.com/wiki/Mountain
    http://journal.example.org/volume/12/issue/3 https://museum.example.com/exhibitions/2023
    https://recipes.example.net/soup/lentil https://science.example.com/physics/optics
    https://www.example.net/about/team https://weather.example.com/forecast/tomorrow
    https://school.example.edu/lessons/algebra http://travel.example.net/fr/lyon
    https://forum.example.com/thread/7781 https://example.net/es/noticias/ciudad
    https://books.example.com/review/novel https://health.example.net/articles/sleep
    https://garden.example.com/plants/tomato https://city.example.net/council/minutes
    https://example.com/en/8123 https://example.net/de/nachrichten/5512
    https://blog.example.com/fr/recette/221 https://maps.example.net/es/ruta/18
""".split()
BLOCKED = """
    http://casino.example.com/slots/free-spins https://cheap-pills.example.net/buy/viagra
    http://win-money.example.com/bonus/jackpot https://xxx.example.net/adult/video
    http://free-download.example.com/crack/keygen https://poker.example.net/bet/now
    http://ads.example.com/click/track?id=1 https://tracker.example.net/pixel/ad
    http://hot-singles.example.com/sex/chat https://replica-watches.example.net/shop/rolex
    http://payday-loans.example.com/apply/cash https://torrent.example.net/warez/movie
    http://betting.example.com/odds/casino https://porn.example.net/xxx/free
    http://miracle-diet.example.com/buy/pills https://crypto-doubler.example.net/win/bonus
    http://spam.example.com/promo/click-here https://adult.example.net/cams/live
    http://lottery.example.com/winner/claim https://cracked-software.example.net/serial/keygen
    http://escort.example.com/girls/hot https://malware.example.net/download/exe
    http://cheap-viagra.example.com/pills/order https://gambling.example.net/roulette/spin
""".split()

BUCKETS = 2048
GRAMS = (3, 4)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), upper, upper.lower())
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return host, path


def buckets(host: Column, path: Column) -> Column:
    """Hashed n-grams of the host (between ``^`` and ``$``) and of the path."""

    def grams(text: Column, mark: str, size: int) -> Column:
        places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.crc32(F.concat(F.lit(mark), F.substr(text, i, F.lit(size))).cast("binary")), F.lit(BUCKETS)).cast("int"))

    framed = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*[grams(text, mark, size) for text, mark in ((framed, "h"), (path, "p")) for size in GRAMS])


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    intercept: float


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{url}', {label}.0D)" for urls, label in ((ALLOWED, 0), (BLOCKED, 1)) for url in urls)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def train(labelled: DataFrame, url: str = "url", label: str = "label", penalty: float = 0.01) -> UrlModel:
    """Fit on a table of addresses with label 1 (block) or 0 (allow); only the weights reach the driver."""
    host, path = host_and_path(F.col(f"`{url}`"))
    found = labelled.select(F.col(f"`{label}`").cast("double").alias("label"), buckets(host, path).alias("found"))
    empty = F.array_repeat(F.lit(0.0), BUCKETS)
    counts = F.aggregate("found", empty, lambda sums, i: F.transform(sums, lambda v, k: v + (k == i).cast("double")))
    fitted = LogisticRegression(regParam=penalty, standardization=False, maxIter=100).fit(found.select("label", array_to_vector(counts).alias("features")))
    return UrlModel(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def block_score(model: UrlModel, host: Column, path: Column) -> Column:
    """Probability of ``block``."""
    weights = F.lit(list(model.weights))
    total = F.aggregate(buckets(host, path), F.lit(model.intercept), lambda sum_, i: sum_ + F.get(weights, i))
    return 1 / (1 + F.exp(-total))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule, or null."""
    chosen = F.lit(None).cast("string")
    for rule, _ in sorted(reversed(rules), key=lambda r: len(r[0])):  # later ones override
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict, score)``; ``score`` is the regression's, also under a rule."""
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.struct(host.alias("host"), path.alias("path")).alias("at"))
    frame = parts.select("page_id", "at.host", "at.path")
    frame = frame.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"), block_score(model, F.col("host"), F.col("path")).alias("score"))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_score = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return frame.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_score).alias("verdict"), "score")
