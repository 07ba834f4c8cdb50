"""URL filter: rules first, else the likelihood ratio of two variable-order Markov models over characters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage

from .common import fold, lower_ascii

_START, _STOP = "\x02", "\x03"
_STRETCH = 256  # characters that are cut into grams at once
_BINS = 4_000  # of the calibration, from -10 to 10


class Rule(NamedTuple):
    """``place`` is a host and a path, such as ``example.net/en/``; it holds for subdomains too."""

    place: str
    verdict: str


# The rules of the query.
RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def with_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` and ``ruled``, place and verdict of the longest rule that fits ``host`` and ``path``."""
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for place, verdict in sorted(rules, key=lambda r: len(r.place)):
        host, slash, path = place.partition("/")
        fits = F.concat(F.lit("."), F.col("host")).endswith(f".{host}")
        fits = fits & F.col("path").startswith(slash + path)
        rule, ruled = F.when(fits, F.lit(place)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruled)
    return df.withColumn("rule", rule).withColumn("ruled", ruled)


def _grams(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row for each character and the end of each text, with the ``order`` characters before it."""
    padded = F.concat(F.lit(_START * order), "text", F.lit(_STOP))
    # a place in a text is found from its start, so long texts are cut into overlapping stretches first
    stretches = F.transform(
        F.sequence(F.lit(0), F.length("text"), F.lit(_STRETCH)), lambda at: F.substring(padded, at + 1, F.lit(_STRETCH + order))
    )

    def inside(stretch):
        places = F.sequence(F.lit(1), F.length(stretch) - order)
        return F.transform(places, lambda at: F.substring(stretch, at, F.lit(order + 1)))

    return texts.select(*keep, F.explode(F.flatten(F.transform(stretches, inside))).alias("gram"))


def ratios(texts: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log of how much likelier the accepted model takes the last character of each gram.

    ``texts`` holds distinct texts with the numbers of accepted and rejected urls. A model mixes its
    estimate of a context with that of the next shorter one in proportion to how many characters
    follow the context (Witten-Bell); below the empty context stands an even share. The grams of all
    texts get a ratio, whether seen in training or not.
    """
    counted = _grams(texts, order, "accepted", "rejected").groupBy("gram")
    counted = stage(counted.agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")), "grams")
    letters = counted.select(F.substring("gram", order + 1, 1)).distinct().count()
    even = 1.0 / (letters + 1)
    lower = None
    for k in range(order + 1):
        own = counted.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("own")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        own = own.withColumn("context", F.substring("own", 1, k)).withColumn("shorter", F.substring("own", 2, k))
        seen = [F.sum(c).alias(f"n_{c}") for c in "ar"] + [F.sum((F.col(c) > 0).cast("long")).alias(f"t_{c}") for c in "ar"]
        rows = splittable_join(own, own.groupBy("context").agg(*seen), ["context"], "inner")
        if lower is None:
            rows = rows.withColumn("p_a", F.lit(even)).withColumn("p_r", F.lit(even))
        else:
            rows = splittable_join(rows, lower, ["shorter"], "inner")
        mixed = [
            F.when(F.col(f"n_{c}") == 0, F.col(f"p_{c}"))
            .otherwise((F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}")))
            .alias(f"p_{c}")
            for c in "ar"
        ]
        lower = rows.select(F.col("own").alias("shorter"), *mixed)
    return lower.select(F.col("shorter").alias("gram"), (F.log("p_a") - F.log("p_r")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score that parts accepted and rejected calibration urls best: most of the first at or above it
    and most of the second below, as shares. 0 where one kind is missing; of equals the one next to 0."""
    bins = F.least(F.greatest(F.floor((F.col("score") + 10) * (_BINS / 20)), F.lit(0)), F.lit(_BINS - 1))
    counts = scored.groupBy(bins.alias("bin")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    found = {r["bin"]: (r["a"], r["r"]) for r in counts.collect()}  # _BINS rows at most
    accepted, rejected = (sum(v[k] for v in found.values()) for k in (0, 1))
    if not accepted or not rejected:
        return 0.0
    above, below, best = accepted, 0, []
    for b in range(_BINS):
        edge = b * 20 / _BINS - 10
        best.append((above / accepted + below / rejected, -abs(edge), edge))
        a, r = found.get(b, (0, 0))
        above, below = above - a, below + r
    return max(best)[2]


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, order: int = 4, folds: int = 10) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each url.

    Urls that a rule accepts or rejects teach the two models; one in ``folds`` of them, by a hash of the
    text, is kept for the threshold instead. The score is the mean log ratio over the characters of host
    and path and the end. A null url or one without ``://`` has empty host and path and is judged by
    how its end scores. Ids may be null or repeated; other columns do no harm; no rows give no rows;
    without urls of one kind the threshold is 0.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = with_rules(parts, rules).withColumn("text", F.concat("host", "path"))
    count = lambda verdict: F.sum((F.col("ruled") == verdict).cast("long"))
    texts = parts.groupBy("text").agg(
        F.coalesce(count("allow"), F.lit(0)).alias("accepted"), F.coalesce(count("block"), F.lit(0)).alias("rejected")
    )
    numbered = texts.withColumns({"kept": fold(F.col("text"), folds), "id": F.monotonically_increasing_id()})
    texts = stage(numbered, "urls")
    teaching = [F.when(F.col("kept"), 0).otherwise(F.col(c)).alias(c) for c in ("accepted", "rejected")]
    model = stage(ratios(texts.select("text", *teaching), order), "ratios")
    # grams carry their text's number: with the text itself, a long one would be written once a character
    scores = _grams(texts, order, "id").join(model, "gram").groupBy("id").agg(F.avg("ratio").alias("score"))
    scores = stage(texts.select("id", "text").join(scores, "id").drop("id"), "scores")
    parting = threshold(texts.where("kept").join(scores, "text"))
    joined = parts.join(scores, "text")
    own = F.when(F.col("score") >= parting, "allow").otherwise("block")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
