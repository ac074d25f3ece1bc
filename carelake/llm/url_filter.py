"""URL filter: host and path rules, and a logistic regression on hashed n-grams for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A rule for `host` and its subdomains, below paths that start with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The labelled URL table: 1 is to be blocked.
LABELLED: tuple[tuple[str, int], ...] = (
    ("https://www.casino-royal.example.com/en/101", 1),
    ("http://online-casino.example.org/play", 1),
    ("https://casino-win.example.net/en/7?ref=x", 1),
    ("https://best-casino-slots.example.com/bonus", 1),
    ("http://free-bets.example.net/en/12", 1),
    ("https://m.free-bets-today.example.org/de/44", 1),
    ("https://sports-bets.example.com/fr/9", 1),
    ("https://bet-and-win.example.com/", 1),
    ("http://cheap-pills.example.org/en/3", 1),
    ("https://www.cheap-pills.example.com/fr/17", 1),
    ("https://buy-pills-online.example.net/order.html", 1),
    ("http://discount-pharmacy-pills.example.com/es/8", 1),
    ("https://hot-xxx-videos.example.com/watch", 1),
    ("http://xxx-cams.example.net/en/live", 1),
    ("https://free-porn.example.org/clip/9", 1),
    ("https://adult-dating.example.com/join", 1),
    ("http://payday-loans.example.net/apply", 1),
    ("https://quick-loans-cash.example.com/en/1", 1),
    ("https://replica-watches.example.org/shop", 1),
    ("http://cheap-replica-bags.example.net/sale", 1),
    ("https://poker-bonus.example.com/en/5", 1),
    ("https://lottery-jackpot.example.org/win", 1),
    ("http://win-free-prizes.example.com/claim", 1),
    ("https://crack-keygen-download.example.net/warez", 1),
    ("https://slots-jackpot-win.example.net/es/2", 1),
    ("http://viagra-online.example.com/buy", 1),
    ("https://work-from-home-money.example.com/rich", 1),
    ("https://weight-loss-miracle.example.org/buy-now", 1),
    ("https://www.spam-farm.example.com/en/11", 1),
    ("http://spam-links.example.org/de/6?ref=x", 1),
    ("https://m.ads-track.example.com/fr/21", 1),
    ("http://ads-track.example.net/en/pixel.html", 1),
    ("https://ads-server.example.org/es/click", 1),
    ("https://www.news.example.com/en/2020/story.html", 0),
    ("https://daily-news.example.org/world/article-7", 0),
    ("http://weather.example.net/en/today", 0),
    ("https://en.wiki.example.org/en/Physics", 0),
    ("https://wiki.example.com/de/Geschichte", 0),
    ("https://docs.example.net/en/guide/install.html", 0),
    ("http://docs.python-guide.example.org/en/tutorial", 0),
    ("https://www.university.example.com/fr/cours/3", 0),
    ("https://library.example.org/es/catalogo/12", 0),
    ("https://blog.garden.example.com/en/825", 0),
    ("http://blog.stone-bridge.example.net/en/25", 0),
    ("https://m.recipes.example.org/fr/tarte", 0),
    ("https://museum.example.com/en/685/", 0),
    ("http://travel.mountain.example.net/es/88", 0),
    ("https://www.science-journal.example.org/en/page/3", 0),
    ("https://health.example.com/en/advice?page=2", 0),
    ("http://school.example.net/en/4196#top", 0),
    ("https://code.example.org/en/repo/9", 0),
    ("https://forum.linux.example.com/en/thread/10219", 0),
    ("https://www.thther.example.org/en/328", 0),
    ("https://m.thonth.example.com/en/48", 0),
    ("http://blog.tionble.example.com/de/373", 0),
    ("https://tionsh.example.net/en/9705.html", 0),
    ("http://therst.example.net/es/4585", 0),
    ("https://ththre.example.com/en/29?utm_source=feed", 0),
    ("http://m.ththnt.example.org/fr/163/", 0),
    ("https://atheas.example.com/de/77", 0),
    ("https://onerwh.example.org/en/12.html", 0),
    ("", 0),
)


def host(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end; A to Z in lower case. Else empty."""
    found = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end. Else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as its text, or null; of equal length the one with the longer host, then by text."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def ngrams(text: Column, mark: str, sizes: tuple[int, ...]) -> Column:
    """Character n-grams between a start and an end mark, each prefixed with `mark`."""
    characters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def of(n: int) -> Column:
        # zipped with its own tails, so that the time grows with the length only
        grams = F.transform(characters, lambda c: F.concat(F.lit(mark), c))
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(characters, k + 1, F.greatest(F.size(characters), F.lit(1))), lambda a, b: F.concat(a, b))
        return grams

    return F.filter(F.concat(*[of(n) for n in sizes]), lambda g: g.isNotNull())


@dataclass(frozen=True)
class UrlModel:
    """Weights of the hashed n-grams, one for each bucket, and the intercept.

    Plain numbers, and no fitted object: a plan that holds one also holds the session
    that it was fitted in, which cannot be sent to tasks.
    """

    weights: tuple[float, ...]
    intercept: float

    def score(self, df: DataFrame) -> DataFrame:
        """`df`, which has host and path, with `score`: the probability of class 1."""
        # parsed once, when the plan is made: a literal of text is far smaller than one of numbers
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(_buckets(len(self.weights)), F.lit(self.intercept), lambda s, b: s + F.get(weights, b))
        return df.withColumn("score", 1.0 / (1.0 + F.exp(-total)))


def _grams() -> Column:
    return F.concat(ngrams(F.col("host"), "h", (3, 4)), ngrams(F.col("path"), "p", (3,)))


def _buckets(buckets: int) -> Column:
    """The distinct buckets of a row's n-grams."""
    return F.array_distinct(F.transform(_grams(), lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int")))


def labelled_urls(spark: SparkSession, rows: tuple[tuple[str, int], ...] = LABELLED) -> DataFrame:
    """A small labelled table (url, label) from literals; nothing but the plan holds it."""
    entries = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(float(y)).alias("label")) for u, y in rows])
    return spark.range(1, numPartitions=1).select(F.inline(entries))


def fit(labelled: DataFrame, buckets: int = 1 << 16) -> UrlModel:
    """A logistic regression on `labelled` (url, label): a small table, whose n-grams the driver reads."""
    rows = labelled.select(
        F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path(F.col("url")), F.lit("")).alias("path"), "label",
    ).coalesce(1)
    found = [(r["label"], r["buckets"]) for r in rows.select("label", _buckets(buckets).alias("buckets")).collect()]
    used = sorted({b for _, hit in found for b in hit})  # the weight of any other bucket stays 0
    entries = []
    for label, hit in found:
        ones = set(hit)
        entries.append(F.struct(
            F.lit(label).alias("label"), F.lit(",".join("1" if b in ones else "0" for b in used)).alias("ones")))
    features = labelled.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*entries))).select(
        "label", array_to_vector(F.split("ones", ",").cast("array<double>")).alias("features"))
    fitted = LogisticRegression(regParam=0.01, maxIter=100, standardization=False).fit(features)
    weights = [0.0] * buckets
    for b, weight in zip(used, fitted.coefficients.toArray().tolist()):
        weights[b] = weight
    return UrlModel(tuple(weights), float(fitted.intercept))


def judge(pages: DataFrame, rules: tuple[Rule, ...], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of `pages` (page_id, url).

    A fitting rule decides; else a score of `threshold` or more blocks. A null url and one
    without `://` have an empty host and path, which the model judges like any other.
    Repeated rows are judged each; other columns are not read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    parts = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    by_rule = parts.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    verdicts = {r.text: r.verdict for r in rules}
    decided = F.lit(None).cast("string")
    for text, verdict in verdicts.items():
        decided = F.when(F.col("rule") == text, verdict).otherwise(decided)
    return model.score(by_rule).select(
        "page_id", "host", "path", "rule",
        F.coalesce(decided, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
