"""Mix sources to target weights by a low-discrepancy schedule.

Every slot of the mix is a golden-ratio point; the cumulative target shares say
which source it falls to. The k-th slot of a source takes the k-th block of
equally many words from the source's shuffled documents, laid end to end and
read round and round. ``first_slot`` of a document is the first slot that takes
words of it; ``mixed_documents`` gives the documents in that order. DataFrame
operations only.

Defined cases: a null or wordless text has size 0 and is never taken; a null
source is a source of its own, ordered last; repeated rows are documents of
their own; an empty table gives an empty result. Columns other than those named
are not looked at, so clashing names do no harm. Equal input rows give equal
results in every run: the shuffle order is the md5 of the id, then the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import cut, word_count

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 512

# Golden-ratio points as integers: i * STEP mod PERIOD, STEP / PERIOD near 0.618.
PERIOD_BITS = 31
STEP = 1_327_217_885
CELL_BITS = 19  # the cumulative shares are looked up through 4,096 equal cells
RANK_BITS = 13  # slots are ranked in runs of 8,192
SHUFFLE_DIGITS = 3  # documents are laid out in 4,096 runs per source
PART_WORDS = 8 << 20  # words in a partition of mixed documents
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES
) -> DataFrame:
    """(skey, source_size, target, words, quota-ready) per source of ``sizes`` (skey, size).

    Targets share the words of all sources by weight; none exceeds
    ``max_passes`` times its source, and the excess goes to the others by weight.
    Filling the sources in the order of cap / weight finds the level in one go.
    One row per source is all that meets in one task.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy("skey")
    by_ratio = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")
    )
    before = lambda name: F.coalesce(F.sum(name).over(by_ratio), F.lit(0))
    return (
        sizes.groupBy("skey")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_passes)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("total") - before("cap"))
        .withColumn("left_weight", F.sum("weight").over(everything) - before("weight"))
        .withColumn(
            "level",
            F.max(F.col("left_words").cast("double") / F.col("left_weight").cast("double")).over(
                everything
            ),
        )
        .withColumn(
            "target",
            F.least(F.col("cap").cast("double"), F.col("weight").cast("double") * F.col("level")),
        )
        .withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("upto", F.sum("words").over(by_name))
        .select("skey", "source_size", "target", "words", "upto")
    )


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(skey, block, slot): which slot of the mix takes which block of a source.

    A source gets as many slots as its target has blocks. The points give each
    source its share to within a few slots; sources still short are served after
    the last point.
    """
    span = F.lit(1 << PERIOD_BITS)
    everything = targets.agg(F.sum("words")).first()[0] or 0
    slots = -(-everything // block_words)
    edges = (
        targets.withColumn("low", F.col("upto") - F.col("words"))
        .withColumn("low", F.floor(F.col("low") / F.lit(max(everything, 1)) * span).cast("long"))
        .withColumn("high", F.floor(F.col("upto") / F.lit(max(everything, 1)) * span).cast("long"))
        .withColumn("quota", F.ceil(F.col("words") / F.lit(block_words)).cast("long"))
        .select("skey", "low", "high", "quota")
    )
    cells = edges.filter("high > low").select(
        "*",
        F.explode(
            F.sequence(
                F.shiftright("low", CELL_BITS), F.shiftright(F.col("high") - 1, CELL_BITS)
            )
        ).alias("cell"),
    )
    points = (
        targets.sparkSession.range(slots)
        .withColumnRenamed("id", "slot")
        .withColumn("point", (F.col("slot") % span) * F.lit(STEP) % span)
        .withColumn("cell", F.shiftright("point", CELL_BITS))
    )
    dealt = (
        points.join(cells, "cell")
        .filter("point >= low and point < high")
        .select("skey", "slot", "quota", F.shiftright("slot", RANK_BITS).alias("run"))
    )
    run_sizes = dealt.groupBy("skey", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = run_sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    within = Window.partitionBy("skey", "run").orderBy("slot")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(within))
        .join(offsets, ["skey", "run"])
        .withColumn("block", F.col("before") + F.col("nth") - 1)
        .filter(F.col("block") < F.col("quota"))
        .select("skey", "block", "slot")
    )
    served = run_sizes.groupBy("skey").agg(F.sum("n").alias("got"))
    short = (
        edges.join(served, "skey", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .filter("got < quota")
        .select("skey", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("block"))
        .withColumn("slot", F.lit(slots) + F.col("block"))
    )
    return ranked.unionByName(short)


def source_key(source: Column) -> Column:
    """Sortable by code point, null last; never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The pieces of the mix, one row per document, pass and block, at least one per document.

    Columns: skey, run, nth (which document), doc_id, size, source_size, target,
    slot (place in the mix), first, n_words (the piece of the document). A
    document the mix leaves out has one row with null slot and no words.
    """
    sized = cut(
        docs.select(
            F.col("doc_id"),
            source_key(F.col("source")).alias("skey"),
            word_count(F.col("text")).alias("size"),
            F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("")).alias("o"),
        )
    ).withColumn("run", F.substring("o", 1, SHUFFLE_DIGITS))
    targets = source_targets(sized, weights, max_passes)
    earlier = Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        sized.groupBy("skey", "run")
        .agg(F.sum("size").alias("run_size"))
        .withColumn("run_start", F.coalesce(F.sum("run_size").over(earlier), F.lit(0)))
        .join(targets, "skey")
        .select("skey", "run", "run_start", "source_size", "target", "words")
    )
    order = Window.partitionBy("skey", "run").orderBy("o", "size")
    start = F.col("run_start") + F.col("upto") - F.col("size")
    laid = (
        sized.withColumn("nth", F.row_number().over(order))
        .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .join(runs, ["skey", "run"])
        .withColumn("start", start)
    )
    at = F.col("start") + F.col("turn") * F.col("source_size")
    end = F.least(at + F.col("size"), F.col("words"))
    low = F.greatest("at", F.col("block") * block_words)
    high = F.least("end", (F.col("block") + 1) * block_words)
    pieces = (
        laid.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))))
        .withColumn("at", at)
        .withColumn("end", end)
        .withColumn("used", F.col("end") > F.col("at"))
        .filter("used or turn = 0")
        .withColumn(
            "block",
            F.explode(
                F.when(
                    F.col("used"),
                    F.sequence(
                        F.floor(F.col("at") / block_words),
                        F.floor((F.col("end") - 1) / block_words),
                    ),
                ).otherwise(F.array((-F.col("nth")).cast("long")))
            ),
        )
        .withColumn("first", F.when(F.col("used"), low - F.col("at")))
        .withColumn("n_words", F.when(F.col("used"), high - low).otherwise(F.lit(0)).cast("long"))
    )
    placed = pieces.join(schedule(targets, block_words), ["skey", "block"], "left")
    return placed.select(
        "skey", "run", "nth", "doc_id", "size", "source_size", "target", "slot", "turn", "first",
        "n_words",
    )


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot), one row per input row."""
    return (
        mix(docs, **options)
        .groupBy("skey", "run", "nth", "doc_id", "size", "source_size", "target")
        .agg(
            F.sum(F.when(F.col("slot").isNotNull(), F.col("n_words")).otherwise(0)).alias("taken"),
            F.min("slot").alias("first_slot"),
        )
        .drop("skey", "run", "nth")
    )


def mixed_passes(docs: DataFrame, **options) -> DataFrame:
    """One row per id and pass that takes words of it.

    ``mix_slot`` is the first slot of the pass, ``mix_upto`` the last one if
    several rows share the id ``mix_doc`` (else the first), ``mix_size`` the words
    of all rows with the id and ``mix_take`` how many of them the pass takes.
    """
    by_row = (
        mix(docs, **options)
        .groupBy("skey", "run", "nth", "turn", "doc_id", "size")
        .agg(
            F.min("slot").alias("slot"), F.max("slot").alias("last"), F.sum("n_words").alias("take")
        )
    )
    of_id = Window.partitionBy("doc_id")
    return (
        by_row.groupBy("doc_id", "turn")
        .agg(
            F.min("slot").alias("mix_slot"),
            F.when(F.count("*") > 1, F.max("last")).otherwise(F.min("slot")).alias("mix_upto"),
            F.sum(F.when(F.col("slot").isNotNull(), F.col("take")).otherwise(0)).alias("mix_take"),
            F.sum("size").alias("reached"),
        )
        # The first pass has a row for every document, reached or not.
        .withColumn("mix_size", F.max(F.when(F.col("turn") == 0, F.col("reached"))).over(of_id))
        .filter("mix_take > 0")
        .select(F.col("doc_id").alias("mix_doc"), "mix_slot", "mix_upto", "mix_take", "mix_size")
    )


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.split(text, WORD_END), F.lit(1), n), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the mix: every row once for each pass that takes words of it.

    Partition after partition, rows stand by the slot their first word falls to.
    The document at which a source reaches its target is cut after the last word
    taken, and ``n_chars``, if there is such a column, is that of the cut text.
    Rows that share an id are taken alike, each by its part of the words, and
    spread over the slots of the id by a hash of their texts.
    """
    passes = cut(mixed_passes(docs, **options))
    words, last = passes.agg(F.sum("mix_take"), F.max("mix_upto")).first()
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-(words or 0) // PART_WORDS))
    per_part = -(-((last or 0) + 1) // parts)
    spread = F.pmod(F.xxhash64("mix_row.text"), F.col("mix_upto") - F.col("mix_slot") + 1)
    # Whole rows in one column, so that no name of theirs can clash with another.
    rows = docs.select(F.struct("*").alias("mix_row"))
    share = F.floor(
        word_count(F.col("mix_row.text")) * F.col("mix_take") / F.col("mix_size") + 0.5
    ).cast("int")
    whole = F.col("mix_take") == F.col("mix_size")
    shorter = F.col("mix_row").withField("text", first_words(F.col("mix_row.text"), F.col("mix_share")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        shorter = shorter.withField("n_chars", F.char_length(shorter["text"]).cast(kind))
    return (
        rows.join(passes, F.col("mix_row.doc_id").eqNullSafe(F.col("mix_doc")))
        .withColumn("mix_share", F.when(whole, 1).otherwise(share))
        .filter("mix_share > 0")
        .withColumn("mix_place", F.col("mix_slot") + spread)
        .repartitionById(parts, F.floor(F.col("mix_place") / per_part).cast("int"))
        .sortWithinPartitions("mix_place", "mix_doc")
        .select(F.when(whole, F.col("mix_row")).otherwise(shorter).alias("mix_row"))
        .select("mix_row.*")
    )
