"""Closed frequent itemsets of baskets, by counting inference over key sets.

A *key* is an itemset whose support is below that of each of its subsets.  Level
by level, a candidate all of whose subsets are keys is counted in the baskets;
any other has the support of its rarest subset, so it is inferred and no basket
is read for it.  Closed sets and rules then follow from supports alone.

Items of a set are ordered from the rarest to the most frequent.  So candidates
grow from rare prefixes, which have few partners, and a very frequent item is
never the key that a group of candidates or occurrences is joined on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Baskets that must hold an itemset, at least.
LEAST = 12
#: One basket of so many must hold an itemset, at least.
ONE_OF = 10_000
#: A rule's confidence in per cent, at least.
CONFIDENCE = 30
#: Pieces into which a basket's rows are dealt where they are joined by basket alone.
SALT = 64

_ITEM = "struct<s:bigint,i:bigint>"
_SETS = f"items array<{_ITEM}>, support long, key boolean"


def baskets(lines: DataFrame, basket: str = "sale_id", item: str = "item_id", flag: str = "flag", without: str = "returned") -> DataFrame:
    """Distinct ``(basket, item)``: rows with a null in either or with the flag ``without`` don't count, a null flag does."""
    kept = lines.where(F.col(basket).isNotNull() & F.col(item).isNotNull() & ~F.col(flag).eqNullSafe(F.lit(without)))
    return kept.select(F.col(basket).cast("long").alias("basket"), F.col(item).cast("long").alias("item")).distinct()


def _subsets(items: str = "items") -> Column:
    """The subsets that lack one item, the k-th lacking the k-th item."""
    n = F.size(items)
    return F.transform(F.sequence(F.lit(1), n), lambda p: F.concat(F.slice(items, F.lit(1), p - 1), F.slice(items, p + 1, n)))


class _Counter:
    """Occurrences of itemsets in ``live(basket, item, s)``, the rows of frequent items.

    ``small`` baskets list their pairs.  The few ``large`` ones never do: there
    are fewer of them than baskets are needed, so a frequent pair stands in a
    small one too, and only such pairs are looked up in the large ones. Which
    baskets are large follows from the data, so no size is a limit.
    """

    def __init__(self, live: DataFrame, least: int):
        self.live, self.least = live, least
        sizes = live.groupBy("basket").agg(F.count("*").alias("n"))
        # At most 64 powers of two.
        powers = {r.p: r.c for r in sizes.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count("*").alias("c")).collect()}
        self.n_large, cut = 0, max(powers, default=0) + 1
        while powers and cut > 1 and self.n_large + powers.get(cut - 1, 0) < least:
            self.n_large += powers.get(cut - 1, 0)
            cut -= 1
        is_large = sizes.where(F.col("n") >= (1 << cut)).select("basket", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")).hint("merge")
        # The salt deals a basket's rows to several tasks.
        dealt = live.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALT)).cast("int"))
        small = dealt.join(is_large, ["basket", "salt"], "left_anti")
        item = F.struct("s", F.col("item").alias("i"))
        self.small = common.materialize(small.groupBy("basket").agg(F.sort_array(F.collect_list(item)).alias("found")).where(F.size("found") > 1), "itemset-small")
        self.large = common.materialize(dealt.join(is_large, ["basket", "salt"], "left_semi").select("basket", "item"), "itemset-large")

    def _pairs(self) -> DataFrame:
        each = self.small.select("basket", "found", F.posexplode("found").alias("p", "a"))
        return each.select("basket", "a", F.explode(F.slice("found", F.col("p") + 2, F.size("found"))).alias("b"))

    def _in_large(self, pairs: DataFrame) -> DataFrame:
        """``(items, basket)`` of the large baskets that hold a pair."""
        first = pairs.select("items", F.col("items")[0]["i"].alias("item"), F.col("items")[1]["i"].alias("other")).join(self.large.hint("merge"), "item")
        return first.select("items", "basket", F.col("other").alias("item")).join(self.large.hint("merge"), ["basket", "item"]).select("items", "basket")

    def pairs(self) -> DataFrame:
        """``(items, n)`` of every pair that enough baskets hold."""
        counted = self._pairs().groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= self.least - self.n_large)
        near = common.materialize(counted.select(F.array("a", "b").alias("items"), "n"), "itemset-pairs")
        if self.n_large:
            more = self._in_large(near).groupBy("items").agg(F.count("*").alias("n"))
            near = near.unionByName(more).groupBy("items").agg(F.sum("n").alias("n"))
        return near.where(F.col("n") >= self.least)

    def occurrences_of_pairs(self, pairs: DataFrame) -> DataFrame:
        found = self._pairs().select("basket", F.array("a", "b").alias("items")).join(pairs.hint("merge"), "items").select("items", "basket")
        return found.unionByName(self._in_large(pairs)) if self.n_large else found

    def extend(self, candidates: DataFrame, occurrences: DataFrame) -> DataFrame:
        """``(items, basket)`` of ``candidates(items, drive, extra)``: baskets of the subset ``drive`` that also hold ``extra``."""
        held = candidates.join(occurrences.withColumnRenamed("items", "drive").hint("merge"), "drive").select("items", "basket", F.col("extra").alias("item"))
        return held.join(self.live.select("basket", "item").hint("merge"), ["basket", "item"]).select("items", "basket")


def _candidates(frequent: DataFrame, size: int) -> DataFrame:
    """Sets of ``size`` items all of whose subsets are frequent: ``items, least, all_keys, drive, extra``.

    ``drive`` is the rarest subset and ``extra`` the item that it lacks.
    """
    by_prefix = frequent.select(F.slice("items", 1, size - 2).alias("prefix"), F.element_at("items", -1).alias("last"))
    grown = by_prefix.join(by_prefix.withColumnRenamed("last", "next").hint("merge"), "prefix").where("last < next")
    each = grown.select(F.concat("prefix", F.array("last", "next")).alias("c")).select("c", F.posexplode(_subsets("c")).alias("p", "items"))
    known = each.join(frequent.hint("merge"), "items")
    rarest = F.min(F.struct("support", F.col("p"), F.col("items").alias("drive")))
    whole = known.groupBy("c").agg(F.count("*").alias("n"), rarest.alias("r"), F.bool_and("key").alias("all_keys")).where(F.col("n") == size)
    return whole.select(F.col("c").alias("items"), F.col("r.support").alias("least"), "all_keys", F.col("r.drive").alias("drive"), F.element_at("c", F.col("r.p") + 1)["i"].alias("extra"))


class Mined:
    """All frequent itemsets: ``sets(items, support, key)``, ``total`` baskets, and the items ``everywhere`` that each basket holds.

    The latter are in no itemset of ``sets``; they add nothing but themselves to
    each. They are at most as many as the smallest basket has items.
    """

    def __init__(self, sets: DataFrame, total: int, everywhere: list[int], counted: int):
        self.sets, self.total, self.everywhere, self.counted = sets, total, everywhere, counted


def mine(rows: DataFrame, least: int = LEAST, one_of: int = ONE_OF) -> Mined:
    """Frequent itemsets of ``rows(basket, item)``, which are distinct.

    ``support >= least and support * one_of >= baskets``. One job counts the
    baskets, one for each level tells whether there is another. Everything that
    grows with the input stays in shuffles and written tables.
    """
    rows = common.materialize(rows, "itemset-rows")
    total = rows.select("basket").distinct().count()
    least = max(least, -(-total // one_of))
    items = common.materialize(rows.groupBy("item").agg(F.count("*").alias("s")).where(F.col("s") >= least), "itemset-items")
    everywhere = sorted(r.item for r in items.where(F.col("s") == total).select("item").collect()) if total else []
    single = items.where(F.col("s") < total)
    live = common.materialize(rows.join(single.hint("merge"), "item").select("basket", "item", "s"), "itemset-live")
    levels = [single.select(F.array(F.struct("s", F.col("item").alias("i"))).alias("items"), F.col("s").alias("support"), F.lit(True).alias("key"))]
    counter = _Counter(live, least)
    pairs = counter.pairs()
    rarer = F.col("items")[0]["s"]
    frequent = common.materialize(pairs.select("items", F.col("n").alias("support"), (F.col("n") < rarer).alias("key")), "itemset-level2")
    occurrences, size, counted = None, 2, 1
    while frequent.limit(1).count():
        levels.append(frequent)
        size += 1
        found = common.materialize(_candidates(frequent, size), f"itemset-candidates{size}")
        inferred = found.where("NOT all_keys").select("items", F.col("least").alias("support"), F.lit(False).alias("key"))
        to_count = found.where("all_keys")
        if to_count.limit(1).count():
            counted = size - 1
            if occurrences is None:
                occurrences = counter.occurrences_of_pairs(to_count.select(F.col("drive").alias("items")).distinct())
            held = common.materialize(counter.extend(to_count.select("items", "drive", "extra"), occurrences), f"itemset-held{size}")
            supports = held.groupBy("items").agg(F.count("*").alias("support")).where(F.col("support") >= least)
            known = supports.join(to_count.select("items", "least").hint("merge"), "items").select("items", "support", (F.col("support") < F.col("least")).alias("key"))
            occurrences = held
            frequent = common.materialize(known.unionByName(inferred), f"itemset-level{size}")
        else:
            frequent = common.materialize(inferred, f"itemset-level{size}")
    return Mined(reduce(DataFrame.unionByName, levels), total, everywhere, counted)


def closed(mined: Mined) -> DataFrame:
    """``items, support`` of the sets that no larger set equals in support, without the items of every basket."""
    above = mined.sets.where(F.size("items") > 1).select(F.explode(_subsets()).alias("items"), "support").groupBy("items").agg(F.max("support").alias("above"))
    return mined.sets.join(above.hint("merge"), "items", "left").where("above IS NULL OR above < support").select("items", "support")


def rules(mined: Mined, sets: DataFrame, confidence: int = CONFIDENCE) -> DataFrame:
    """``items, rules``: of each set the rules ``(c, a, s)`` by ``c``: the rest of the set, which ``a`` baskets hold, speaks for ``c``, which ``s`` hold.

    A rule's confidence is ``confidence`` per cent or more, and it is held more
    often than by chance. An item of every basket is in no rule.
    """
    each = sets.where(F.size("items") > 1).select("items", "support", F.posexplode(_subsets()).alias("p", "rest"))
    a = mined.sets.select(F.col("items").alias("rest"), F.col("support").alias("a")).hint("merge")
    found = each.join(a, "rest").withColumn("c", F.element_at("items", F.col("p") + 1))
    good = found.where((100 * F.col("support") >= confidence * F.col("a")) & (F.col("support") * mined.total > F.col("a") * F.col("c.s")))
    return good.groupBy("items").agg(F.sort_array(F.collect_list(F.struct(F.col("c.i").alias("c"), "a", F.col("c.s").alias("s")))).alias("rules"))


def itemsets(lines: DataFrame, least: int = LEAST, one_of: int = ONE_OF, confidence: int = CONFIDENCE) -> DataFrame:
    """``items (array), support, rules (array)`` of every closed itemset of sale lines.

    Repeated rows of an item in a basket count once; a basket is all rows of its
    number, however many. Rows with a null basket or item don't count, a null
    flag is a flag. Equal supports are no ties: sets are told apart by items.
    An empty table gives no row; extra columns aren't read.
    """
    mined = mine(baskets(lines), least, one_of)
    sets = common.materialize(closed(mined), "itemset-closed")
    ids = F.transform("items", lambda x: x["i"])
    found = sets.join(rules(mined, sets, confidence).hint("merge"), "items", "left")
    everywhere = F.array(*(F.lit(i).cast("long") for i in mined.everywhere)) if mined.everywhere else F.array().cast("array<bigint>")
    none = F.array().cast("array<struct<c:bigint,a:bigint,s:bigint>>")
    out = found.select(F.array_sort(F.concat(ids, everywhere)).alias("items"), "support", F.coalesce("rules", none).alias("rules"))
    if mined.everywhere:
        one = lines.sparkSession.range(1).select(everywhere.alias("items"), F.lit(mined.total).cast("long").alias("support"), none.alias("rules"))
        out = out.unionByName(one)
    return out


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    told = F.transform("rules", lambda r: F.concat_ws(":", r["c"].cast("string"), r["a"].cast("string"), r["s"].cast("string")))
    best = F.array_min(F.transform("rules", lambda r: F.struct(r["a"].alias("a"), r["c"].alias("c"))))["c"]
    return found.select(
        F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), F.size("items").cast("long").alias("n_items"), F.col("support").cast("long").alias("support"),
        F.size("rules").cast("long").alias("n_rules"), best.alias("best_item"), F.sha2(F.array_join(told, ";").cast("binary"), 256).alias("rules_sha256"),
    )
