"""URL filter: given host and path rules, then mined association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, light, settle

#: Labelled urls that a rule needs, whatever their share.
LEAST = 20
#: Share that a rule needs of the labelled urls with its tokens.
CONFIDENCE = 0.6
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (``host/path``) that fits, as (rule, verdict); else null.

    A rule fits its host and all subdomains if the path starts with its own.
    """
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        own = (host == name) | host.endswith("." + name)
        fits.append(F.when(own & path.startswith("/" + rest), F.struct(F.lit(rule).alias("rule"),
                                                                       F.lit(rules[rule]).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    """Distinct tokens of a url, sorted: host labels, path words, query keys, without numbers."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host "), x))
    words = F.transform(F.split(F.lower(path), r"[^\p{L}\p{N}-]+"), lambda x: F.concat(F.lit("path "), x))
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query "), F.lower(F.substring_index(x, "=", 1))))
    return F.array_sort(F.array_distinct(F.filter(F.concat(labels, words, keys), lambda t: ~t.rlike(r" [0-9-]*$"))))


def merged(rows: DataFrame) -> DataFrame:
    """``token``, ``item``: tokens that occur in exactly the same ``rows`` (``key``, ``tokens``) are one
    item, named by the first of them; those that occur in all rows are none.

    Any set of such tokens has the same rows, so one item says what all their subsets
    would. Rows are compared by two hashes of their keys: the exclusive-or and the sum.
    """
    n = rows.count()
    key = F.col("key")
    seen = rows.select("key", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(key)).alias("a"),
        F.sum(F.xxhash64(key, F.lit(1)).cast("decimal(38,0)")).alias("b")).where(F.col("n") < n)
    firsts = seen.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return settle(seen.join(firsts, ["n", "a", "b"]).select("token", "item"))


def mine(labelled: DataFrame, url_col: str = "url", verdict_col: str = "verdict", support: float = 0.0,
         confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """Rules ``items``, ``tokens``, ``verdict``, ``confidence``, ``support`` mined by
    FP-growth from labelled urls (verdict ``allow`` or ``block``).

    A rule needs ``least`` of the labelled urls, however many there are (and the share ``support`` of
    them). All tokens of a url count; tokens of exactly the same labelled urls are one
    item (see ``merged``): ``items`` has its name and ``tokens``, in the same order, all that stand for it.
    Only rules that raise their verdict above its share in all labels are kept.
    No labelled rows: no rules.
    """
    spark = labelled.sparkSession
    rows = settle(labelled.where(F.col(verdict_col).isin(ALLOW, BLOCK)).select(
        F.monotonically_increasing_id().alias("key"), tokens(F.col(url_col)).alias("tokens"), F.col(verdict_col).alias("verdict")))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "items array<string>, tokens array<array<string>>, verdict string, confidence double, support double")
    item_of = merged(rows)
    items = rows.select("key", F.explode("tokens").alias("token")).join(light(item_of), "token").groupBy("key").agg(
        F.collect_set("item").alias("items"))
    verdict = F.array(F.concat(F.lit("verdict "), F.col("verdict")))
    # urls whose tokens all others have too count with their verdict alone
    carts = settle(rows.join(items, "key", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), verdict).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(least / n, support)), minConfidence=confidence).fit(carts)
    found = model.associationRules.where(F.col("consequent")[0].startswith("verdict ") & (F.col("lift") > 1))
    found = found.where(~F.exists("antecedent", lambda t: t.startswith("verdict ")))
    found = settle(found.select(F.array_sort("antecedent").alias("items"), F.substring_index(F.col("consequent")[0], " ", -1).alias("verdict"),
                                "confidence", "support"))
    named = item_of.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("names"))
    place = found.select("items", "verdict", F.posexplode("items").alias("place", "item")).join(named, "item")
    wide = place.groupBy("items", "verdict").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "names"))), lambda x: x["names"]).alias("tokens"))
    return settle(found.join(wide, ["items", "verdict"]).select("items", "tokens", "verdict", "confidence", "support"))


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens``, ``verdict`` of the distinct token sets in which all items of a rule occur, each
    by any one of its tokens.

    Inverted index: a rule stands under all tokens of its rarest item only, and a set looks up
    its own tokens. The most confident rule wins, then the best supported, then blocking.
    """
    often = rules.select(F.explode("items").alias("item")).groupBy("item").count()
    seen = rules.select("items", "verdict", F.posexplode("items").alias("place", "item")).join(often, "item")
    rarest = seen.groupBy("items", "verdict").agg(F.min(F.struct("count", "item", "place"))["place"].alias("place"))
    index = rules.join(rarest, ["items", "verdict"]).select(
        F.explode(F.col("tokens")[F.col("place")]).alias("token"), F.col("tokens").alias("wanted"), "verdict", "confidence", "support")
    rank = F.struct("confidence", "support", F.col("verdict") == BLOCK, "verdict")
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(light(settle(index)), "token").where(
        F.forall("wanted", lambda names: F.arrays_overlap(names, F.col("tokens"))))
    return hits.groupBy("tokens").agg(F.max(rank)["verdict"].alias("verdict"))


def judge(pages: DataFrame, given: dict[str, str], rules: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting given rule decides; without one the mined rules; without
    one of those the url is allowed. Defined cases: null url or one without
    ``://`` has empty host and path and no token, and is allowed; very long urls
    are read whole; repeated rows agree; extra columns are kept, those with the
    names above are replaced.
    """
    out = ("host", "path", "rule", "verdict")
    said, own, key, mined = fresh(pages, "said", "tokens", "key", "mined")
    url = F.col(url_col)
    read = pages.withColumn(said, given_rule(host_of(url), path_of(url), given)).withColumn(own, tokens(url))
    sets = read.where(F.col(said).isNull()).select(F.col(own).alias("tokens")).distinct()
    found = settle(match(sets, rules).select(F.col("tokens").alias(key), F.col("verdict").alias(mined)))
    joined = read.join(light(found), F.col(own) == F.col(key), "left")
    kept = [F.col(c) for c in pages.columns if c.lower() not in out]
    return joined.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"), F.col(f"{said}.rule").alias("rule"),
                         F.coalesce(F.col(f"{said}.verdict"), F.col(mined), F.lit(ALLOW)).alias("verdict"))
