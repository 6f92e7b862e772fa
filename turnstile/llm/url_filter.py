"""URL filters: a rule list, and association rules mined by FP-growth for the rest.

Tokens describe a url: scheme, every suffix of the host, every directory, extension,
every query key, fragment; whole, each once.  FP-growth mines token
sets together with the label; rules "tokens -> label" with enough support and
confidence are indexed under their rarest token.  A url looks its tokens up in that
index, keeps the rules whose other tokens it has too, and takes the most
confident one (then larger support, longer, first by text).  Without a rule the
verdict is ``default``.

Support prunes: tokens of fewer labelled pages than a rule needs aren't mined, and
tokens that occur on the same labelled pages (told by a 128-bit hash over them) are mined as
one, which any of them stands for, so that a deep path doesn't make all subsets of itself.

The rule list comes first: a rule fits its host and all subdomains if the
url's path starts with the rule's; the longest wins.

Urls with equal tokens are looked up once.  Everything is DataFrame work; the
mined rules stay a DataFrame.

Defined cases: null urls and urls without "://" have empty host and path; null
or repeated ids are judged row by row; without labels there are no mined rules;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule): the fixed rules of the query
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, what follows the path)."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(found, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^?#]*(.*)$", 1)
    return F.translate(host, UPPER, LOWER), path, tail


def tokens() -> Column:
    """The tokens of _url, from the columns host, path and tail."""
    labels, dirs = F.split("host", r"\."), F.split("path", "/", -1)
    named = lambda kind, values: F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(f"{kind}="), v))
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    folders = F.transform(F.slice(dirs, 1, F.greatest(F.size(dirs) - 1, F.lit(0))), lambda d: F.regexp_replace(d, "[0-9]+", "0"))
    asked = F.regexp_extract("tail", r"(?s)^\?([^#]*)", 1)
    keys = F.transform(F.split(asked, "[&;]"), lambda q: F.regexp_extract(q, "(?s)^([^=]*)", 1))
    single = F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract("_url", "^([A-Za-z0-9+.-]+)://", 1))),
                     F.concat(F.lit("file="), F.regexp_extract("path", r"(\.[A-Za-z0-9]+|/)$", 1)),
                     F.when(F.instr("tail", "#") > 0, F.lit("fragment=yes")))
    made = F.concat(named("host", suffixes), named("dir", folders), named("query", keys),
                    F.filter(F.array_compact(single), lambda t: ~t.endswith("=")))
    return F.array_sort(F.array_distinct(made))


def listed(rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest fitting rule of a list, as struct (size, rule, verdict), or null."""
    fits = [F.lit(None).cast("struct<size: int, rule: string, verdict: string>")]
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        fit = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fits)))


def mine(urls: DataFrame, labels: DataFrame, *, min_support: float, min_confidence: float, least_pages: int) -> tuple[DataFrame, DataFrame]:
    """(rules, classes): pruned rules (tokens, verdict, confidence, support) over token classes, and the
    class of each frequent token.  urls: _uid, tokens; labels: _uid, verdict."""
    marked = materialize(urls.join(labels.dropna().distinct(), "_uid").select("_uid", "verdict", "tokens"))
    least = max(least_pages, math.ceil(min_support * marked.count()))
    each = marked.select("_uid", "verdict", F.explode("tokens").alias("token"))
    page = F.xxhash64("_uid", "verdict")
    pages = [F.count("*").alias("n"), F.bit_xor(page).alias("h1"), F.sum(F.xxhash64(F.lit(1), "_uid", "verdict").cast("decimal(20,0)")).alias("h2")]
    often = each.groupBy("token").agg(*pages).filter(F.col("n") >= least)
    names = often.groupBy("n", "h1", "h2").agg(F.min("token").alias("class"))
    classes = materialize(often.join(names, ["n", "h1", "h2"]).select("token", "class"))
    baskets = (each.join(classes, "token").groupBy("_uid", "verdict").agg(F.collect_set("class").alias("set"))
               .select(F.concat("set", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items")))
    baskets = materialize(baskets)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / max(baskets.count(), 1)), minConfidence=min_confidence).fit(baskets)
    got = model.associationRules.withColumn("verdict", F.get("consequent", F.lit(0)))
    rules = (got.filter(F.col("verdict").startswith("verdict=") & ~F.exists("antecedent", lambda t: t.startswith("verdict=")))
             .select(F.array_sort("antecedent").alias("tokens"), F.expr("substring(verdict, 9)").alias("verdict"), "confidence", "support"))
    return rules, classes


def match(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, best): for each distinct token set the best rule that it holds."""
    often = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # the token that the fewest rules have stands for a rule in the index
    each = rules.withColumn("token", F.explode("tokens")).join(often, "token")
    index = each.groupBy("tokens", "verdict", "confidence", "support").agg(
        F.min_by("token", F.struct("n", "token")).alias("class")).withColumnRenamed("tokens", "needs")
    held = sets.withColumn("token", F.explode("tokens")).join(classes, "token").groupBy("tokens").agg(F.collect_set("class").alias("held"))
    found = held.withColumn("class", F.explode("held")).join(index, "class").filter(F.size(F.array_except("needs", "held")) == 0)
    best = F.struct("confidence", "support", F.size("needs").alias("n"), F.array_join("needs", " ").alias("text"), "verdict")
    return found.groupBy("tokens").agg(F.max(best).alias("best"))


def judge(pages: DataFrame, labels: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          label_id: str = "page_id", label_col: str = "verdict", rules: tuple[tuple[str, str], ...] = RULES,
          min_support: float = 0.002, min_confidence: float = 0.6, least_pages: int = 5, default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (listed), verdict, mined (the tokens of the mined rule that decided).

    A mined rule has ``least_pages`` labelled pages and ``min_support`` of all of them at least."""
    urls = pages.select(F.col(id_col).alias("_uid"), F.col(url_col).cast("string").alias("_url"))
    host, path, tail = parts(F.col("_url"))
    urls = urls.withColumns({"host": host, "path": path, "tail": tail}).withColumn("tokens", tokens()).drop("tail", "_url")
    marked = labels.select(F.col(label_id).alias("_uid"), F.col(label_col).alias("verdict"))
    mined, classes = mine(urls.select("_uid", "tokens"), marked, min_support=min_support, min_confidence=min_confidence, least_pages=least_pages)
    best = match(urls.select("tokens").distinct(), mined, classes)
    own = listed(rules)
    out = urls.join(best, "tokens", "left").withColumn("own", own)
    return out.select(F.col("_uid").alias(id_col), "host", "path", F.col("own.rule").alias("rule"),
                      F.coalesce("own.verdict", "best.verdict", F.lit(default)).alias("verdict"),
                      F.when(F.col("own").isNull(), F.col("best.text")).alias("mined"))


def held_out_agreement(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(verdict, judged, n, by_rule): labelled pages outside the rule list that weren't learned from (a third of all), by label and verdict."""
    third = F.pmod(F.xxhash64("page_id", "verdict"), F.lit(3)) == 0
    judged = judge(pages, labels.filter(~third), **options).filter("rule is null").select("page_id", F.col("verdict").alias("judged"), "mined")
    return labels.filter(third).join(judged, "page_id").groupBy("verdict", "judged").agg(
        F.count("*").alias("n"), F.count("mined").alias("by_rule"))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, verdict) of pages whose path ends with a labelled document's id: block for a bad or toxic one, else allow."""
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:\.html|/)?(?:[?#].*)?$", 1)
    of = pages.select("page_id", F.when(F.length(number) > 0, number).cast("long").alias("doc_id")).dropna()
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return of.join(labels, "doc_id").select("page_id", F.when(bad, "block").otherwise("allow").alias("verdict"))


def digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """op2: page_id, host, path, rule, verdict and the mined rule's tokens."""
    ensure_checkpoint_dir(pages.sparkSession)
    return judge(pages, labelled(pages, labels))
