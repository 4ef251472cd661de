"""Mixing sources to target weights by hierarchical budgeting.

The leaves of the tree are the (domain, language, source) groups that the documents have. A node's token
budget is divided among its children by their weights. A child cannot take more than the tokens below
it times ``epochs``; what it leaves goes to its siblings by their weights, and only what all of them
leave goes back to the parent's siblings. Dividing from the root, with each child limited by all that
lies below it, gives just that.

A leaf with a quota of several times its tokens gives whole epochs, each with all documents, and from
the last epoch a prefix: documents in an order seeded by the epoch, as long as their tokens fit. The
end of the prefix is found from token sums over ranges of the order, narrowed twice, so no task sees
all documents of a leaf; it is one number per leaf that documents are compared with.

A null domain, language or source counts as the empty text; a null text has no tokens, and documents
without tokens go with the whole epochs and with the prefix. Rows that repeat a doc_id are taken or left
together in the last epoch. Without documents or budget nothing is chosen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchledger.llm.common import put_back, set_apart
from benchledger.session import settle

LEVELS = ("domain", "lang", "source")
#: Share of all tokens that the mix holds, and how often a document may be taken.
BUDGET_SHARE = 0.5
EPOCHS = 2
SEED = 20
DOMAINS = 4
#: Weights of nodes by their path from the root; others have 1.
WEIGHTS: Mapping[tuple[str, ...], float] = {
    ("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain3",): 1.0,
    **{(f"domain{number}", "en"): 3.0 for number in range(DOMAINS)},
    **{(f"domain{number}", "de"): 2.0 for number in range(DOMAINS)},
}
#: The order is narrowed to ranges of keys that share all but so many bits.
RANGE_BITS = (54, 44)


def domain_of(source: Column) -> Column:
    """The domain of a source where documents name none: a fixed group of sources."""
    name = F.coalesce(source, F.lit(""))
    return F.concat(F.lit("domain"), (F.crc32(name.cast("binary")) % DOMAINS).cast("string"))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def with_leaf(documents: DataFrame) -> DataFrame:
    """Adds the leaf's path and the tokens, in columns that clash with none of a corpus."""
    domain = F.coalesce(F.col("domain").cast("string"), F.lit("")) if "domain" in documents.columns else domain_of(F.col("source"))
    path = [domain, *(F.coalesce(F.col(name).cast("string"), F.lit("")) for name in LEVELS[1:])]
    return documents.withColumns(
        {**{f"_{name}": value for name, value in zip(LEVELS, path, strict=True)}, "_tokens": count_words(F.col("text"))}
    )


PATH = [f"_{name}" for name in LEVELS]


def order_key(epoch: Column, doc_id: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("bigint"), F.coalesce(doc_id.cast("string"), F.lit("")))


def divided(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Adds ``_budget``: the parent's ``_parent_budget`` divided by ``_weight`` within ``_limit``.

    Children fill up in the order of limit / weight. One is full if, of what the earlier ones leave, its
    share by weight reaches its limit; what the full ones leave is divided among the others.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("_limit") / F.col("_weight"), *PATH[: len(parents) + 1])
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("_parent_budget") - F.coalesce(F.sum("_limit").over(earlier), F.lit(0))
    shares = nodes.withColumn("_share", left / F.sum("_weight").over(later))
    # Shares rise until the first child that is not full, and that child's share holds for the rest.
    level = F.min(F.when(F.col("_limit") > F.col("_share") * F.col("_weight"), F.struct(F.col("_limit") / F.col("_weight"), "_share")))
    return (
        shares.withColumn("_level", level.over(Window.partitionBy(*parents))["_share"])
        .withColumn("_budget", F.coalesce(F.least(F.col("_limit"), F.col("_level") * F.col("_weight")), F.col("_limit")))
        .drop("_share", "_level")
    )


def quotas(
    leaves: DataFrame, weights: Mapping[tuple[str, ...], float], budget: Column, epochs: int = EPOCHS
) -> DataFrame:
    """``leaves`` (path, _tokens) with ``_quota``; ``budget`` is a column over the sum ``_all`` of tokens."""
    spark = leaves.sparkSession
    rows = [("\x00".join(path), float(weight)) for path, weight in weights.items() if weight > 0]
    table = spark.createDataFrame(rows, "_key string, _weight double")

    def weighted(nodes: DataFrame, depth: int) -> DataFrame:
        key = F.array_join(F.array(*PATH[:depth]), "\x00")
        return nodes.withColumn("_key", key).join(F.broadcast(table), "_key", "left").withColumn(
            "_weight", F.coalesce("_weight", F.lit(1.0))
        ).drop("_key")

    top = Window.partitionBy()  # a handful of domains
    done: DataFrame | None = None
    for depth in range(1, len(PATH) + 1):
        nodes = leaves.groupBy(*PATH[:depth]).agg((F.sum("_tokens") * epochs).cast("double").alias("_limit"))
        nodes = weighted(nodes, depth)
        if done is None:
            total = F.sum("_limit").over(top) / epochs
            nodes = nodes.withColumn("_all", total).withColumn("_parent_budget", budget.cast("double")).drop("_all")
        else:
            parent = done.select(*PATH[: depth - 1], F.col("_budget").alias("_parent_budget"))
            nodes = nodes.join(parent, PATH[: depth - 1])
        done = divided(nodes, PATH[: depth - 1])
    return leaves.join(done.select(*PATH, F.floor("_budget").alias("_quota")), PATH)


def prefix_ends(slim: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Per leaf ``_whole`` epochs and ``_last_key``: the greatest key of the last epoch's prefix."""
    state = leaves.select(
        *PATH,
        F.floor(F.col("_quota") / F.col("_tokens")).alias("_whole"),
        (F.col("_quota") % F.col("_tokens")).alias("_rest"),
        F.lit(None).cast("bigint").alias("_range"),
    )
    tokens = F.col("_sum")
    bits_before = None
    for bits in (*RANGE_BITS, 0):
        rows = slim.join(state, PATH).withColumn("_order", order_key(F.col("_whole"), F.col("doc_id"), seed))
        if bits_before is not None:
            rows = rows.filter(F.shiftright("_order", bits_before) == F.col("_range"))
        sums = (
            rows.groupBy(*PATH, "_whole", "_rest", "_range", F.shiftright("_order", bits).alias("_bin"))
            .agg(F.sum("_tokens").alias("_sum"))
            .withColumn("_so_far", F.sum("_sum").over(Window.partitionBy(*PATH).orderBy("_bin")))
        )
        if bits:
            cut = F.min(F.when(F.col("_so_far") > F.col("_rest"), F.struct("_bin", (F.col("_rest") - F.col("_so_far") + tokens).alias("_left"))))
            state = sums.groupBy(*PATH, "_whole").agg(cut.alias("_cut")).select(
                *PATH, "_whole", F.col("_cut._left").alias("_rest"), F.col("_cut._bin").alias("_range")
            )
            state = settle(state, "mix-ranges")
            bits_before = bits
        else:
            fits = F.max(F.when(F.col("_so_far") <= F.col("_rest"), F.col("_bin")))
            before = F.shiftleft(F.first("_range"), bits_before) - 1
            state = sums.groupBy(*PATH, "_whole").agg(F.coalesce(fits, before).alias("_last_key"))
    return state


def mix(
    documents: DataFrame,
    weights: Mapping[tuple[str, ...], float] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The chosen documents, with ``domain``, ``n_tokens`` and ``epoch`` (0, 1, ...): a row per epoch.

    Columns of these names, in whatever case, are replaced (``domain`` is read, if there is one); all others
    stay, whatever their names.
    """
    read = ["doc_id", "text", "lang", "source", *(["domain"] if "domain" in map(str.lower, documents.columns) else [])]
    named = with_leaf(set_apart(documents, *read))
    slim = settle(named.select("doc_id", *PATH, "_tokens"), "mix-documents")
    leaves = slim.groupBy(*PATH).agg(F.sum("_tokens").alias("_tokens")).filter(F.col("_tokens") > 0)
    leaves = settle(leaves, "mix-leaves")
    leaves = settle(quotas(leaves, weights, F.col("_all") * budget_share, epochs), "mix-quotas")
    ends = settle(prefix_ends(slim, leaves, seed), "mix-ends")
    key = order_key(F.col("_whole"), F.col("doc_id"), seed)
    taken = F.col("_whole") + F.when(key <= F.col("_last_key"), 1).otherwise(0)
    rows = named.join(ends, PATH).withColumn("_taken", taken.cast("int")).filter(F.col("_taken") > 0)
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_taken") - 1)))
    return put_back(rows, documents, read, {"domain": F.col("_domain"), "n_tokens": F.col("_tokens"), "epoch": F.col("_epoch")})


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch of the chosen documents."""
    chosen = mix(documents.select(F.col("doc_id").cast("bigint"), "text", "lang", "source"))
    return chosen.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")
