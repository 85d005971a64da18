"""URL filter: rules first, then a character language-model ratio.

Rules allow or block hosts (with their subdomains) and path prefixes; the
longest rule that fits decides. The URLs that rules decide also train two
variable-order Markov models over characters, one of allowed and one of
blocked URLs: contexts of three characters down to none, interpolated by
Witten-Bell smoothing, down to the uniform distribution. A URL without a
rule is judged by its length-normalised log-likelihood difference against a
threshold that is calibrated on rule-decided URLs left out of training.

DataFrame functions only. A gram table has at most 41^4 rows (the alphabet
is folded to 41 symbols) whatever the number of URLs, and pre-aggregation
shrinks the grams of a task to that before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import saved

ORDER = 3              # characters of context at most
HELD_OUT = 4           # one rule-decided URL of so many calibrates, the others train
BIN = 0.02             # width of the score bins of the calibration
BROADCAST_GRAMS = 200_000
ALPHABET = 41          # a-z, digits as one, . / - _ ? = & % # + : , the rest, start, end

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def folded(url: Column) -> Column:
    """What the models read: the URL without scheme, lower-cased, digits as 0, other
    characters as ~, between start and end marks."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"(?s)^.*?://", "")
    rest = F.regexp_replace(F.regexp_replace(rest, "[0-9]", "0"), r"[^a-z0./_?=&%#+:,\-]", "~")
    return F.concat(F.lit("^" * ORDER), rest, F.lit("$"))


def _grams(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - ORDER), lambda i: F.substring(text, i, F.lit(ORDER + 1)))


def gram_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio) from (gram, a, r), counts in allowed and blocked URLs (0 where a
    gram is in neither): ln P_allowed - ln P_blocked of its last character in its context."""
    out = grams.select("gram", F.lit(1.0 / ALPHABET).alias("pa"), F.lit(1.0 / ALPHABET).alias("pr"))
    for k in range(1, ORDER + 2):
        tail = F.substring("gram", ORDER + 2 - k, k)
        seen = grams.groupBy(tail.alias("tail")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = (seen.groupBy(F.substring("tail", 1, k - 1).alias("context"))
                   .agg(F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"),
                        F.count_if(F.col("r") > 0).alias("tr")))
        level = (seen.withColumn("context", F.substring("tail", 1, k - 1)).join(context, "context")
                 .select("tail", "a", "r", "na", "nr", "ta", "tr"))
        mix = lambda n, t, c, p: F.when(n + t == 0, p).otherwise((c + t * p) / (n + t))
        out = (out.withColumn("tail", tail).join(level, "tail")
               .select("gram", mix(F.col("na"), F.col("ta"), F.col("a"), F.col("pa")).alias("pa"),
                       mix(F.col("nr"), F.col("tr"), F.col("r"), F.col("pr")).alias("pr")))
    return out.select("gram", (F.ln("pa") - F.ln("pr")).alias("ratio"))


def _threshold(bins: list, default: float = 0.0) -> float:
    """The lower edge of a bin that best parts the classes (largest difference of the
    shares at or above it; the lowest such edge)."""
    good, bad = sum(r["a"] for r in bins), sum(r["r"] for r in bins)
    if not good or not bad:
        return default
    best, at, a, r = 0.0, default, 0, 0
    for row in sorted(bins, key=lambda x: -x["bin"]):
        a, r = a + row["a"], r + row["r"]
        gain = a / good - r / bad
        if gain >= best:
            best, at = gain, row["bin"] * BIN
    return at


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
           rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule, verdict, score, threshold.

    ``verdict`` is the rule's, or allow where the score (mean log ratio a
    character) reaches the threshold. Without rule-decided URLs of both
    kinds the threshold is 0. A null or empty url, or one without ``://``,
    has an empty host and path, no rule and the score of what text it has.
    Long urls are read whole. Rows that repeat are all returned with the same
    result; an empty table gives no rows. Other columns are not looked at.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    parts = base.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = parts.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).select(
        "id", "url", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("given"),
        folded(F.col("url")).alias("text"), (F.pmod(F.crc32(F.coalesce("url", F.lit(""))), F.lit(HELD_OUT)) == 0).alias("held"))
    shown = known.select("given", "held", F.explode(_grams(F.col("text"))).alias("gram"))
    learn = lambda verdict: F.count_if((F.col("given") == verdict) & ~F.col("held"))
    grams = saved(shown.groupBy("gram").agg(learn("allow").alias("a"), learn("block").alias("r")), "grams")
    ratios = saved(gram_ratios(grams), "ratios")
    if ratios.count() <= BROADCAST_GRAMS:
        ratios = F.broadcast(ratios)
    key = ["id", "url", "host", "path", "rule", "given", "held"]
    scored = saved(
        known.select(*key, F.length("text").alias("n"), F.explode(_grams(F.col("text"))).alias("gram"))
        .join(ratios, "gram").groupBy(*key, "n")
        # Equal rows fall together; each has n - ORDER grams.
        .agg(F.sum("ratio").alias("total"), F.count("*").alias("count"))
        .withColumn("grams", F.col("n") - ORDER)
        .select(*key, (F.col("total") / F.col("count")).alias("score"),
                F.explode(F.sequence(F.lit(1), (F.col("count") / F.col("grams")).cast("int"))).alias("copy")).drop("copy"),
        "urls")
    share = lambda verdict: F.count_if(F.col("given") == verdict)
    bins = (scored.filter("held and given is not null")
            .groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(share("allow").alias("a"), share("block").alias("r")))
    # Scores are mean log ratios of smoothed probabilities: some thousand bins at most.
    threshold = _threshold(bins.collect())
    verdict = F.coalesce("given", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block")))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score",
                         F.lit(threshold).alias("threshold"))
