"""URL filter: explicit host/path rules first, else association rules mined by FP-growth (no Python on rows).

A url's items are its host, the host's labels, its path's segments (numbers as one item), the parts of labels
and segments between ``-``, ``_``, ``.`` and ``:``, its file ending and its query's names.  FP-growth over the
urls labelled ``bad`` finds the item combinations that they share; those of which enough rows, and a large enough
part of all rows that hold them, are bad become blocking rules.  Only what can make a rule is mined: items in
too few bad rows are left out; an item that is a rule by itself is in no longer rule; items that occur in the same
bad rows are mined as one, whose rule asks for all of them, so urls of one host with many fixed segments make one
combination and not all its subsets.  A rule that only adds items to another one goes.

Rules are found by an inverted index: each rule is listed under its rarest item, urls are reduced to their
distinct item sets first, so a host with a third of all urls is matched a few times, and the other items are
checked.

Defined results: a null url or one without ``://`` has empty host and path and no items, and is allowed;
repeated rows are judged row by row; a row without a label isn't mined; without labelled urls, or with good ones only, no
rule is mined; an empty table gives no rows.  Columns named like a result are replaced by it.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import stored

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
MIN_ROWS = 5
_P = "__ur_"
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _AZ, _az)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def items_of(url: Column) -> Column:
    """The distinct items of a url, sorted."""
    host, path = host_of(url), path_of(url)
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(
        F.lit("path:"), F.when(s.rlike(r"^\d+(\.\w+)?$"), F.lit("#")).otherwise(s)))
    ending = F.regexp_extract(path, r"\.(\w+)$", 1)
    query = F.transform(F.filter(F.split(F.coalesce(F.regexp_extract(url, _URL, 3), F.lit("")), "&"), lambda s: s != ""),
                        lambda s: F.concat(F.lit("query:"), F.substring_index(s, "=", 1)))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    label = F.regexp_extract(host, r"^([^.]+)\.", 1)
    tokens = F.filter(F.split(F.concat_ws("/", host, path), r"[-_./:]+"), lambda s: ~s.rlike(r"^\d*$"))
    parts = F.transform(tokens, lambda s: F.concat(F.lit("part:"), F.translate(s, _AZ, _az)))
    labels = F.transform(F.filter(F.split(host, r"\."), lambda s: s != ""), lambda s: F.concat(F.lit("label:"), s))
    one = lambda name, c: F.when(c != "", F.array(F.concat(F.lit(name), c))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(
        one("host:", host), one("domain:", domain), one("first:", label), one("top:", F.regexp_extract(host, r"([^.]+)$", 1)),
        labels, parts, segments, one("ending:", ending), query)))


def _without_longer(rules: DataFrame) -> DataFrame:
    """The rules (rule_id, items, key, ..) that hold no other rule."""
    inner = rules.select(F.col("items").alias("need"), "key", F.col("rule_id").alias("other"))
    longer = rules.select("rule_id", "items", F.explode("items").alias("key")).join(inner, "key")
    longer = longer.where((F.col("rule_id") != F.col("other")) & (F.size(F.array_except("need", "items")) == 0))
    return rules.join(longer.select("rule_id").distinct(), "rule_id", "left_anti")


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """(rule_id, items, key, confidence, support) of the rules ``items => bad``; ``key`` is the rarest item.

    A rule has at least ``min_rows`` bad rows and the share ``min_support`` of all labelled ones.  FP-growth keeps at
    most items/min_support frequent items on the driver; its conditional trees are grouped by item over the
    executors.  Items that nearly always, but not always, occur together still make many combinations.
    """
    rows = labelled.select(items_of(F.col(url)).alias("items"), F.col(bad).alias("bad")).where((F.size("items") > 0) & F.col("bad").isNotNull())
    sets = stored(rows.groupBy("items").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad")), "baskets")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(min_rows, math.ceil(min_support * total), 1)
    # the bad rows of an item: their number, and 128 bits over the distinct item sets among them
    of = lambda seed: F.when(F.col("n_bad") > 0, F.xxhash64(F.lit(seed), F.col("items")))
    item = sets.select("n", "n_bad", of(1).alias("a"), of(2).alias("b"), F.explode("items").alias("item"))
    item = item.groupBy("item").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    item = stored(item.where(F.col("n_bad") >= least), "items")
    alone = F.col("n_bad") >= min_confidence * F.col("n")
    single = item.where(alone).select(F.array("item").alias("items"), F.col("item").alias("key"), "n", "n_bad")
    # items with the same bad rows, all of one url: the first stands for them
    same = stored(item.where(~alone).groupBy("n_bad", "a", "b").agg(
        F.sort_array(F.collect_list("item")).alias("members"), F.min(F.struct("n", "item"))["item"].alias("key"), F.min("n").alias("key_n")).select(
        F.col("members")[0].alias("item"), "members", "key", "key_n"), "same-rows")
    bad_sets = sets.where("n_bad > 0").select("n_bad", F.xxhash64("items").alias("a"), F.xxhash64(F.lit(2), "items").alias("b"), F.explode("items").alias("item"))
    bad_sets = bad_sets.join(same.select("item"), "item").groupBy("a", "b", "n_bad").agg(F.collect_list("item").alias("items"))
    baskets = stored(bad_sets.select("items", F.explode(F.sequence(F.lit(1), "n_bad"))).select("items"), "bad-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(1, baskets.count()))).fit(baskets)
    found = stored(model.freqItemsets.select(F.concat_ws("\x01", F.array_sort("items")).alias("id"), "items", F.col("freq").alias("n_bad")), "combinations")
    whole = found.select("id", "n_bad", F.explode("items").alias("item")).join(same, "item").groupBy("id", "n_bad").agg(
        F.array_sort(F.flatten(F.collect_list("members"))).alias("items"), F.min(F.struct("key_n", "key"))["key"].alias("key"))
    whole = stored(whole, "combinations")
    held = sets.select("n", "items", F.explode("items").alias("key")).join(whole.select("id", "key", F.col("items").alias("need")), "key")
    held = held.where(F.size(F.array_except("need", "items")) == 0).groupBy("id").agg(F.sum("n").alias("n"))
    several = whole.join(held, "id").where(F.col("n_bad") >= min_confidence * F.col("n")).select("items", "key", "n", "n_bad")
    rules = single.unionByName(several).select(F.concat_ws(" ", "items").alias("rule_id"), "items", "key",
                                               (F.col("n_bad") / F.col("n")).alias("confidence"), (F.col("n_bad") / max(1, total)).alias("support"))
    rules = stored(rules, "url-rules")
    return stored(_without_longer(rules), "url-index")


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(items, rule_id, confidence): each distinct item set with the rules that it contains."""
    probe = sets.select("items", F.explode("items").alias("key"))
    r = rules.select(F.col("items").alias("need"), "key", "rule_id", "confidence")
    return probe.join(r, "key").where(F.size(F.array_except("need", "items")) == 0).select("items", "rule_id", "confidence")


def fits(host: Column, path: Column, rule: str) -> Column:
    h, _, p = rule.partition("/")
    return ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))


def judge(pages: DataFrame, mined: DataFrame, explicit: dict[str, str], url: str = "url") -> DataFrame:
    """Every row of ``pages`` with host, path, rule, mined_rule, verdict.

    ``explicit``: rule (``host/path``) -> allow or block, a list of configuration size; the longest that fits
    wins.  Other urls are blocked if a mined rule fits (the most confident one is given), else allowed.
    """
    p = pages.drop(*[c for c in ("host", "path", "rule", "mined_rule", "verdict") if c != url])
    p = p.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), _P + "items": F.concat_ws("\x01", items_of(F.col(url)))})
    order = sorted(explicit, key=lambda r: (-len(r), r))
    rule = F.coalesce(*[F.when(fits(F.col("host"), F.col("path"), r), F.lit(r)) for r in order]) if order else F.lit(None).cast("string")
    said = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in explicit.items()], F.lit(None).cast("string"))
    sets = p.where(F.col(_P + "items") != "").select(F.col(_P + "items").alias("set")).distinct().select(F.split("set", "\x01").alias("items"))
    best = matches(sets, mined).groupBy("items").agg(F.max_by("rule_id", F.struct("confidence", "rule_id")).alias("mined_rule"))
    best = stored(best.select(F.concat_ws("\x01", "items").alias(_P + "key"), "mined_rule"), "url-verdicts")
    p = p.join(best, p[_P + "items"] == best[_P + "key"], "left").drop(_P + "items", _P + "key").withColumn("rule", rule)
    return p.withColumn("verdict", F.coalesce(said, F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))))
