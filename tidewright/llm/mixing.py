"""Mixing sources to target weights by hierarchical budgeting, in DataFrame expressions only.

The tree has three levels under its root: domain, language, source; a leaf is one source within one
language of one domain. A node's capacity is the tokens of its leaves times the epochs allowed.
The root's budget is dealt out by weight; what a node can't use goes to its siblings, by weight
again, until they are full too. Doing so from the top down, with capacities summed from the bottom
up, moves a shortage among siblings first and among ancestors only when the whole family is full.

Each leaf takes a prefix of its tokens in an order seeded anew for each epoch: whole epochs first,
then the shortest prefix of the next epoch's order that reaches the budget. The order is by md5 of
seed, epoch and doc_id. The cut is found without ever sorting a leaf: token sums of the 256 first
md5 octets name the octet that holds it, once more for the second octet, and a window runs over what is left, a
65536th of the leaf. A document then compares its own md5 with the leaf's cut.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import common

LEVELS = ("domain", "lang", "source")
WORD = r"[^ \t\n\r\f\x0B]+"
#: Leaves up to this many are broadcast; beyond, the join shuffles.
BROADCAST_LEAVES = 20_000


@dataclass(frozen=True)
class Targets:
    """Integer weights by node name for each level; 1 where a name isn't listed."""

    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)

    def weight(self, level: str) -> Column:
        out = F.lit(1).cast("long")
        for name, w in getattr(self, level).items():
            if w < 1:
                raise ValueError("weights are positive integers")
            out = F.when(F.col(level) == name, F.lit(w).cast("long")).otherwise(out)
        return out


def default_domain(source: Column) -> Column:
    """The source's trailing number modulo three; 'none' without one."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(digits == "", "none").otherwise(F.concat(F.lit("d"), (digits.cast("long") % 3).cast("string")))


def tokens(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _names(df: DataFrame, domain: Column | None) -> DataFrame:
    """The columns of the tree; a null language or source is the node ''."""
    named = df.withColumn("domain", default_domain(F.col("source")) if domain is None else domain)
    return named.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LEVELS})


def deal(nodes: DataFrame, family: list[str], name: str, budget: Column) -> DataFrame:
    """Adds share: the family's budget dealt by weight among nodes with capacities, in whole tokens.

    Nodes are ordered by capacity for each unit of weight. One is full if the budget, less the
    capacities before it, would give it its capacity or more. The others share the rest by weight,
    rounded so that the sum is exact. Families are as large as the tree is wide, not as the data.
    """
    wide = "decimal(38,0)"
    order = Window.partitionBy(*family).orderBy(F.col("capacity") / F.col("weight"), name) if family else Window.partitionBy(F.lit(0)).orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    df = nodes.withColumn("budget", budget).withColumn("used", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("open_weight", F.sum("weight").over(after))
    df = df.withColumn("full", F.col("capacity").cast(wide) * F.col("open_weight").cast(wide) <= (F.col("budget") - F.col("used")).cast(wide) * F.col("weight").cast(wide))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(every), F.lit(0)))
    df = df.withColumn("open_sum", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)).withColumn("upto", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    share = F.expr("cast(rest as decimal(20,0)) * cast(upto as decimal(17,0)) div cast(open_sum as decimal(17,0)) - cast(rest as decimal(20,0)) * cast(upto - weight as decimal(17,0)) div cast(open_sum as decimal(17,0))")
    return df.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long")).drop("budget", "used", "open_weight", "full", "rest", "open_sum", "upto")


def budgets(leaves: DataFrame, targets: Targets, total: Column, max_epochs: int) -> DataFrame:
    """domain, lang, source, leaf_tokens, share for a table with those columns but the last.

    total is the root's budget; beyond the root's capacity it is cut to that.
    """
    leaf = leaves.withColumn("total", total).withColumn("capacity", F.col("leaf_tokens") * max_epochs)
    by_lang = leaf.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"), F.max("total").alias("total"))
    by_domain = by_lang.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.max("total").alias("total"))
    root = F.least(F.col("total"), F.sum("capacity").over(Window.partitionBy(F.lit(0))))
    domains = deal(by_domain.withColumn("weight", targets.weight("domain")).withColumn("root", root), [], "domain", F.col("root")).select("domain", F.col("share").alias("above"))
    langs = deal(by_lang.join(domains, "domain").withColumn("weight", targets.weight("lang")), ["domain"], "lang", F.col("above")).select("domain", "lang", F.col("share").alias("above"))
    dealt = deal(leaf.join(langs, ["domain", "lang"]).withColumn("weight", targets.weight("source")), ["domain", "lang"], "source", F.col("above"))
    return dealt.select(*LEVELS, "leaf_tokens", "share")


def plan(slim: DataFrame, targets: Targets, budget_percent: int, max_epochs: int, seed: int) -> DataFrame:
    """For each leaf: leaf_tokens, share, epochs (whole ones), cut (the greatest md5 of the part epoch; null: none).

    slim has the tree's columns, doc_id and n_tokens.
    """
    leaves = common.durable(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("leaf_tokens")))
    total = (leaves.agg(F.sum("leaf_tokens")).first()[0] or 0) * int(budget_percent) // 100
    dealt = budgets(leaves, targets, F.lit(total).cast("long"), max_epochs)
    dealt = dealt.withColumn("epochs", F.when(F.col("leaf_tokens") > 0, F.expr("share div leaf_tokens")).otherwise(0).cast("int"))
    part = common.durable(dealt.withColumn("need", F.col("share") - F.col("epochs") * F.col("leaf_tokens")))
    rows = _with(slim, part.filter("need > 0").select(*LEVELS, "epochs", "need")).filter("n_tokens > 0")
    rows = rows.withColumn("k", order_key(seed, F.col("epochs"), F.col("doc_id")))
    for level in range(2):
        octet = F.substring("k", 1 + 2 * level, 2)
        sums = rows.groupBy(*LEVELS, "need", octet.alias("octet")).agg(F.sum("n_tokens").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("octet").rowsBetween(Window.unboundedPreceding, 0))
        at = sums.withColumn("upto", upto).filter("upto >= need and upto - n < need").select(*LEVELS, "octet", (F.col("need") - F.col("upto") + F.col("n")).alias("left"))
        at = common.durable(at)
        rows = _with(rows.drop("need"), at).filter(octet == F.col("octet")).withColumnRenamed("left", "need").drop("octet")
    upto = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("k"))  # by range: equal keys go together
    cuts = rows.withColumn("upto", upto).filter("upto >= need").groupBy(*LEVELS).agg(F.min("k").alias("cut"))
    return common.durable(part.join(cuts, list(LEVELS), "left").select(*LEVELS, "leaf_tokens", "share", "epochs", "cut"))


def _with(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows joined to their leaf; leaves are broadcast only when they have been counted to be few."""
    small = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if small else leaves, list(LEVELS))


def mix(documents: DataFrame, targets: Targets, budget_percent: int, max_epochs: int = 4, seed: int = 42, domain: Column | None = None) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, leaf_tokens, share, copies: how often each document is taken.

    The budget is budget_percent of all tokens. Null texts and texts without a word have no tokens;
    they are taken as often as their leaf has whole epochs. Rows that repeat a doc_id share its place
    in the order and are taken together. A null doc_id counts as an empty one. Very long texts count whole, as one document; extra
    columns are ignored. An empty table gives no rows.
    """
    own = common.pick(documents, "doc_id", "text", "lang", "source")
    slim = common.durable(_names(own, domain).select("doc_id", *LEVELS, tokens(F.col("text")).alias("n_tokens")))
    leaves = plan(slim, targets, budget_percent, max_epochs, seed)
    k = order_key(seed, F.col("epochs"), F.col("doc_id"))
    copies = F.col("epochs") + F.when((F.col("n_tokens") > 0) & (k <= F.col("cut")), 1).otherwise(0)
    return _with(slim, leaves).select("doc_id", *LEVELS, "n_tokens", "leaf_tokens", "share", copies.cast("int").alias("copies"))


def take(documents: DataFrame, targets: Targets, budget_percent: int, max_epochs: int = 1, seed: int = 42, domain: Column | None = None) -> DataFrame:
    """The documents themselves, each repeated as often as mix() takes it; all their columns.

    No text is shuffled: the leaves' cuts go to the rows. Nulls, empty and very long texts, repeated rows and an empty table are as in mix().
    """
    own = common.pick(documents, "doc_id", "text", "lang", "source")
    slim = common.durable(_names(own, domain).select("doc_id", *LEVELS, tokens(F.col("text")).alias("n_tokens")))
    leaves = plan(slim, targets, budget_percent, max_epochs, seed)
    plain, at = common.numbered(documents)
    names = {c: f"mix_{c}" for c in (*LEVELS, "epochs", "cut")}
    named = _names(plain.withColumns({c: F.col(at[c]) for c in ("doc_id", "text", "lang", "source")}), domain)
    side = leaves.select(*[F.col(c).alias(n) for c, n in names.items()])
    on = F.lit(True)
    for c in LEVELS:
        on = on & (named[c] == F.col(names[c]))
    joined = named.join(F.broadcast(side) if leaves.count() <= BROADCAST_LEAVES else side, on)
    k = order_key(seed, F.col("mix_epochs"), F.col("doc_id"))
    extra = F.when((tokens(F.col("text")) > 0) & (k <= F.col("mix_cut")), 1).otherwise(0)
    out = joined.withColumn("mix_copies", (F.col("mix_epochs") + extra).cast("int")).filter("mix_copies > 0")
    if max_epochs > 1:
        out = out.withColumn("mix_copies", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return out.select(*plain.columns).toDF(*documents.columns)
