"""Mixing sources to target weights, with DataFrame functions only.

The words of each source, documents in a hashed order, form one sequence that is cut into
blocks of ``block`` words. A source whose target is ``target`` words gets a slot for each block
it has to give: all blocks for every whole round of its words, then the first blocks of one more
round, the last of them cut to what is still missing. The round's block order is a pseudorandom
index permutation, ``index = (prime * k + offset) mod blocks``, with prime and offset drawn from
a hash of source and round. Every slot draws its output shard from a hash, so a shard's counts
by source are multinomial, while each source's total stays at its target. Slots and blocks meet
in a join on (source, block), whose keys hold a few rows each whatever the size of a source.

Positions inside a source come from sums per (source, hash bucket) and a running sum inside each
bucket, so no task sees a whole source. One row per source, and one per bucket of a source,
passes through an ordered window.

Defined results: NULL or blank texts have size 0 and are taken 0 times; a NULL source is a source
of its own, last in the order; repeated rows are documents of their own, and rows that agree in
source, id and text stand beside one another; an empty table gives an empty result. ``taken`` ignores
extra columns, ``mixed`` keeps them under their names, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import SPACE_CLASS, SPACES, WORD_CLASS, cut, without

#: Fixed primes; a block count below 10^12 is divisible by two of them at most.
_PRIMES = (1000003, 1100009, 1200007, 1299709)


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (5, 2, 1)
    ratio: float = 1.5
    most: float = 2.0
    block: int = 128
    shard_slots: int = 4096
    bucket_rows: int = 4096
    seed: int = 9


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_CLASS + "+"))).cast("long")


def _numbered(docs: DataFrame) -> DataFrame:
    """``_hash`` of the text, and ``_copy``, the number among rows that agree in id, source and text."""
    keyed = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull()))
    same = Window.partitionBy("doc_id", "source", "_hash").orderBy("doc_id")
    return keyed.withColumn("_copy", F.row_number().over(same))


def placed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, source, _hash, _copy, _s (source as a key), size, _at (place in its source)."""
    sized = cut(_numbered(docs.select(
        "doc_id", "source", "text", word_count(F.col("text")).alias("size"))).select(
        "doc_id", "source", "_hash", "_copy", "size",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("~")).alias("_s"),
    ))
    buckets = max(1, -(-sized.count() // settings.bucket_rows))
    order = F.xxhash64(F.lit(settings.seed), "doc_id", "_hash", "_copy")
    rows = sized.withColumn("_order", order).withColumn("_bucket", F.pmod(F.col("_order"), F.lit(buckets)))
    sums = rows.groupBy("_s", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_s", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_s", "_bucket").orderBy("_order", "doc_id", "_copy")
    running = rows.withColumn("_run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return cut(running.join(before, ["_s", "_bucket"]).select(
        "doc_id", "source", "_hash", "_copy", "_s", "size",
        (F.col("_before") + F.col("_run") - F.col("size")).alias("_at"),
    ))


def targets(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per source: _s, source_size, target (words).

    Sources share ``ratio`` times all words by weight; a source stops at ``most`` times its own
    size, and the excess is shared again by weight among the others.
    """
    sizes = rows.groupBy("_s").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy("_s")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in settings.weights]),
                         ((F.row_number().over(place) - 1) % len(settings.weights) + 1).cast("int"))
    weighed = sizes.select("_s", "source_size", cycle.alias("_w")).withColumn("_cap", settings.most * F.col("source_size"))
    # Sources fill up in the order of cap by weight. The first one that the level computed
    # without those before it does not overfill sets the level of the rest.
    fills = Window.orderBy(F.col("_cap") / F.col("_w"), "_s")
    whole = Window.partitionBy()
    full = F.coalesce(F.sum("_cap").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(fills.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = weighed.select(
        "*", ((settings.ratio * F.sum("source_size").over(whole) - full) / rest).alias("_level"))
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    every = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    common = F.first(fits, ignorenulls=True).over(every)
    return level.select(
        "_s", "source_size", F.least("_cap", F.coalesce(common * F.col("_w"), F.col("_cap"))).alias("target"))


def slots(per_source: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """_s, shard, slot, round, _block, _want (words of the block that the slot takes)."""
    b = settings.block
    plan = per_source.where("source_size > 0").select(
        "_s", "source_size",
        F.ceil(F.col("source_size") / b).alias("_blocks"),
        F.floor(F.col("target") / F.col("source_size")).alias("_rounds"),
        "target",
    ).withColumn("_rest", F.round(F.col("target") - F.col("_rounds") * F.col("source_size")).cast("long"))
    plan = plan.withColumn("_slots", F.col("_rounds") * F.col("_blocks") + F.ceil(F.col("_rest") / b))
    total = plan.agg(F.coalesce(F.sum("_slots"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // settings.shard_slots))
    # A large source becomes many short runs of slots first, and those are spread over the tasks.
    runs = plan.where("_slots > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / 65536))).alias("_piece"))
    each = runs.repartition("_s", "_piece").select(
        "*", F.explode(F.sequence(
            F.col("_piece") * 65536, F.least(F.col("_slots"), (F.col("_piece") + 1) * 65536) - 1)).alias("slot"))
    turn = F.floor(F.col("slot") / F.col("_blocks"))
    k = F.col("slot") % F.col("_blocks")
    drawn = F.xxhash64(F.lit(settings.seed), "_s", "round")
    prime = F.lit(_PRIMES[-1])
    for i, p in enumerate(_PRIMES[:-1]):
        prime = F.when((F.pmod(drawn, F.lit(len(_PRIMES))) <= i) & (F.col("_blocks") % p != 0), F.lit(p)).otherwise(prime)
    prime = F.when(F.col("_blocks") % prime == 0, F.lit(15485863)).otherwise(prime)
    index = (prime.cast("long") * k + F.pmod(drawn, F.col("_blocks"))) % F.col("_blocks")
    last = (F.col("round") == F.col("_rounds")) & (k == F.ceil(F.col("_rest") / b) - 1)
    return each.withColumn("round", turn).select(
        "_s", "slot", "round",
        F.pmod(F.xxhash64(F.lit(settings.seed), "_s", "slot", F.lit("shard")), F.lit(shards)).alias("shard"),
        index.alias("_block"),
        F.when(last, F.col("_rest") - k * b).otherwise(F.lit(b)).alias("_want"),
    )


def pieces(rows: DataFrame, per_source: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mix: one row per piece of a document in a slot.

    shard, _s, slot, round, doc_id, _hash, _copy, _at, start (first word, 0-based), length.
    """
    b = settings.block
    held = rows.where("size > 0").select(
        "doc_id", "_hash", "_copy", "_s", "size", "_at",
        F.explode(F.sequence(F.floor(F.col("_at") / b), F.floor((F.col("_at") + F.col("size") - 1) / b))).alias("_block"))
    # The planner can't know how many slots a source row becomes: never broadcast them.
    joined = held.join(slots(per_source, settings).hint("merge"), ["_s", "_block"])
    low = F.greatest(F.col("_at"), F.col("_block") * b)
    high = F.least(F.col("_at") + F.col("size"), F.col("_block") * b + F.col("_want"))
    return joined.where(low < high).select(
        "shard", "_s", "slot", "round", "doc_id", "_hash", "_copy", "_at",
        (low - F.col("_at")).alias("start"), (high - low).alias("length"))


def taken(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words in the mix)."""
    rows = placed(docs, settings)
    per_source = cut(targets(rows, settings))
    words = pieces(rows, per_source, settings).groupBy("_s", "_at").agg(F.sum("length").alias("_taken"))
    # Place and source name one row among those that have words.
    return (
        rows.withColumn("_place", F.when(F.col("size") > 0, F.col("_at")).otherwise(-1 - F.abs(F.xxhash64("doc_id", "_copy") % 1000000)))
        .join(words.withColumnRenamed("_at", "_place"), ["_s", "_place"], "left")
        .join(per_source, "_s")
        .select("doc_id", "source", "size", "source_size", "target",
                F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: a row per document and round.

    A text taken whole stays as it is; of others the taken words remain, each with the white
    space behind it, in their order. ``n_chars``, if there is one, is counted again.
    """
    columns = docs.columns
    # Extra columns travel under numbered names, whatever they are called.
    names = [c if c in ("doc_id", "source", "text", "n_chars") else f"_extra{i}" for i, c in enumerate(columns)]
    docs = docs.toDF(*names)
    rows = placed(docs, settings)
    per_source = cut(targets(rows, settings))
    spans = pieces(rows, per_source, settings).groupBy("doc_id", "_s", "_hash", "_copy", "round").agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_spans"), F.sum("length").alias("_words"))
    texts = _numbered(docs).withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("~")))
    keys = {"_id": "doc_id", "_source": "_s", "_text": "_hash", "_number": "_copy"}
    spans = spans.select(*[F.col(c).alias(k) for k, c in keys.items()], "_spans", "_words")
    met = F.col("_id").eqNullSafe(F.col("doc_id"))
    for k in ("_source", "_text", "_number"):
        met = met & (F.col(k) == F.col(keys[k]))
    joined = texts.join(spans, met).select(*names, "_spans", "_words")
    words = F.split(F.ltrim(F.btrim("text", F.lit(SPACES))), f"(?<={SPACE_CLASS})(?={WORD_CLASS})")
    cut_words = joined.withColumn("_pieces", F.when(F.col("_words") < word_count(F.col("text")), words))
    part = F.concat_ws("", F.flatten(F.transform(
        "_spans", lambda s: F.slice(F.col("_pieces"), (s["start"] + 1).cast("int"), s["length"].cast("int")))))
    text = F.when(F.col("_pieces").isNull(), F.col("text")).otherwise(F.btrim(part, F.lit(SPACES)))
    out = without(cut_words.withColumn("text", text), "_spans", "_words", "_pieces")
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names).toDF(*columns)
