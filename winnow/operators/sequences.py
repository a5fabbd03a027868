"""Token sequences for training: packing, budget, mixing, stages, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.text import count_tokens, let, tokens
from winnow.operators.sampling import smallest_hashes
from winnow.operators.skew import ranked
from winnow.session import materialize

# The training budget and its two stages.
SEQUENCE_LENGTH = 2048
TRAIN_STEPS = 10
MICRO_BATCH = 2
ACCUMULATION = 4
DATA_PARALLEL = 1
STAGES = (("Stable Training Stage", 1), ("Annealing Phase", 10))


def global_batch(
    micro: int = MICRO_BATCH, accum: int = ACCUMULATION, dp: int = DATA_PARALLEL
) -> int:
    return micro * accum * dp


def pack_sequences(
    df: DataFrame, seq_len: int = SEQUENCE_LENGTH, id: str = "id", text: str = "text"
) -> DataFrame:
    """(block, tokens): all token streams in id order, cut in blocks of `seq_len`; no short tail.

    Token offsets come from a distributed running sum over the counts of texts. Each text is cut
    into its pieces where it is, and pieces, not tokens, go to the block they belong to. Texts of
    one id, and rows without one, which come first, follow each other by a hash of their text;
    equal rows are one text that is laid down as often as it occurs.
    """
    known = df.select(
        F.col(id).alias("_id"),
        F.col(text).alias("_text"),
        F.md5(F.concat_ws(":", F.col(id).isNull(), F.col(id), F.col(text))).alias("_key"),
    )
    counted = known.select("_id", "_key", count_tokens(F.col("_text")).cast("long").alias("_n"))
    # Written once: range partitioning reads its input twice, and that should not be the text.
    counts = materialize(
        counted.where("_n > 0").groupBy("_id", "_key").agg(F.max("_n").alias("_n"), F.count("*").alias("_times")),
        "counts",
    )
    starts = ranked(counts, [], [F.col("_id"), F.col("_key")], F.col("_n") * F.col("_times")).select(
        "_key", "_n", "_times", F.col("_before").alias("_first")
    )

    def piece(words: Column, block: Column) -> Column:
        first = F.greatest(block * seq_len - F.col("_start"), F.lit(0).cast("long"))
        last = F.least((block + 1) * seq_len - F.col("_start"), F.col("_n")) - 1
        return F.struct(
            block.alias("block"),
            (F.col("_start") + first).alias("at"),
            F.slice(words, (first + 1).cast("int"), (last - first + 1).cast("int")).alias("part"),
        )

    first_block = F.floor(F.col("_start") / seq_len)
    last_block = F.floor((F.col("_start") + F.col("_n") - 1) / seq_len)
    pieces = let(
        tokens(F.col("_text")),
        lambda words: F.transform(
            F.sequence(first_block, last_block), lambda block: piece(words, block)
        ),
    )
    # Grouped by what they are joined by, texts are moved once; copies are put together before.
    texts = known.groupBy("_key").agg(F.first("_text").alias("_text"))
    copies = F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)
    placed = texts.join(starts.hint("merge"), "_key").select(
        "_text", "_n", F.explode(F.transform(copies, lambda k: F.col("_first") + k * F.col("_n"))).alias("_start")
    )
    parts = placed.select(F.inline(pieces))
    # A block holds at most seq_len tokens, so the list per block is bounded.
    ordered = F.array_sort(F.collect_list(F.struct("at", "part")))
    return (
        parts.groupBy("block")
        .agg(F.flatten(F.transform(ordered, lambda p: p.getField("part"))).alias("tokens"))
        .where(F.size("tokens") == seq_len)
    )


def block_count(df: DataFrame, seq_len: int = SEQUENCE_LENGTH, text: str = "text") -> DataFrame:
    """One row (blocks): how many blocks `pack_sequences` makes, from token counts alone."""
    tokens_ = F.coalesce(F.sum(count_tokens(F.col(text)).cast("long")), F.lit(0))
    return df.agg(F.floor(tokens_ / seq_len).alias("blocks"))


def token_budget(
    blocks: DataFrame,
    steps: int = TRAIN_STEPS,
    batch: int = global_batch(),
    seq_len: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """One row: tokens needed and there, whether they suffice, and the most steps possible.

    `blocks` comes from `block_count`.
    """
    return blocks.select(
        F.lit(steps * batch * seq_len).cast("long").alias("needed"),
        (F.col("blocks") * seq_len).alias("have"),
        (F.col("blocks") * seq_len >= steps * batch * seq_len).alias("enough"),
        F.floor(F.col("blocks") / batch).alias("max_steps"),
    )


def weighted_mix(
    sources: dict[str, DataFrame], weights: dict[str, float], n: int, seed: int = 0, id: str = "id"
) -> DataFrame:
    """n rows from several frames in the given proportions, with `source` and `copy`.

    A source smaller than its part is repeated in whole passes, and the last, partial pass takes
    the rows with the smallest seeded hash.
    """
    total = sum(weights.values())
    mixed, taken, share = None, 0, 0.0
    for name, df in sources.items():
        share += weights[name] / total
        part = int(round(share * n, 6)) - taken
        taken += part
        size = df.count()
        passes, rest = divmod(part, size) if size else (0, 0)
        whole = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(max(passes, 1)))))
        rows = whole if passes else whole.limit(0)
        if rest:
            last = smallest_hashes(df, rest, seed, id).withColumn("copy", F.lit(passes + 1))
            rows = rows.unionByName(last)
        rows = rows.withColumn("source", F.lit(name))
        mixed = rows if mixed is None else mixed.unionByName(rows)
    return mixed


def batch_plan(
    blocks: DataFrame,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    dp: int = DATA_PARALLEL,
) -> DataFrame:
    """Step, micro batch and slot of every block; an incomplete last batch is dropped.

    `blocks` comes from `block_count`; its one number is read to lay out the plan.
    """
    batch = global_batch(micro, accum, dp)
    count = blocks.first()["blocks"]
    return blocks.sparkSession.range(count // batch * batch).select(
        F.col("id").alias("block"),
        F.floor(F.col("id") / batch).alias("step"),
        F.floor(F.col("id") % batch / micro).alias("micro_batch"),
        (F.col("id") % batch % micro).alias("slot"),
    )


def data_stages(
    plan: DataFrame,
    stages: tuple[tuple[str, int], ...] = STAGES,
    steps: int = TRAIN_STEPS,
    done: int = 0,
) -> DataFrame:
    """Per stage: its steps, blocks planned and consumed after `done` steps, steps remaining.

    Steps count from 1; a stage runs until the next one starts, the last one through `steps`.
    """
    ordered = sorted(stages, key=lambda s: s[1])
    ends = [start for _, start in ordered[1:]] + [steps + 1]
    step = F.col("step") + 1

    def pick(value) -> Column:
        result = None
        for (name, start), end in zip(ordered, ends):
            inside = (step >= start) & (step < end)
            item = F.lit(value(name, start, end))
            result = F.when(inside, item) if result is None else result.when(inside, item)
        return result

    return (
        plan.withColumn("stage", pick(lambda name, start, end: name))
        .withColumn("remaining", pick(lambda name, start, end: max(end - max(start, done + 1), 0)))
        .where("stage is not null")
        .groupBy("stage")
        .agg(
            F.min(step).alias("first_step"),
            F.max(step).alias("last_step"),
            F.count(F.lit(1)).alias("planned"),
            F.count_if(step <= done).alias("consumed"),
            F.first("remaining").alias("remaining_steps"),
        )
    )
