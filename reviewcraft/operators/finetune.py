"""Chat examples from summaries: messages, reproducible split, template text, length check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv

_BUCKET_HEX_DIGITS = 4


def chat_messages(
    input_context: Column,
    target_summary: Column,
    system_prompt: str = fv.CHAT_SYSTEM_PROMPT,
    user_prefix: str = fv.CHAT_USER_PREFIX,
) -> Column:
    """System, user and assistant message of one example."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        message("system", F.lit(system_prompt)),
        message("user", F.concat(F.lit(user_prefix), input_context)),
        message("assistant", target_summary),
    )


def to_chat_examples(summaries: DataFrame, *keep: str) -> DataFrame:
    """``messages`` per summary, besides the columns named in ``keep``."""
    messages = chat_messages(F.col("input_context"), F.col("target_summary"))
    return summaries.select(*keep, messages.alias("messages"))


def render_chat(messages: Column) -> Column:
    """The messages as one text with start and end tags, without a prompt for a reply."""

    def turn(message: Column) -> Column:
        return F.concat(
            F.lit(fv.CHAT_TURN_START),
            message.getField("role"),
            F.lit("\n"),
            message.getField("content"),
            F.lit(fv.CHAT_TURN_END + "\n"),
        )

    return F.array_join(F.transform(messages, turn), "")


def split_key(key: Column, seed: int = fv.SEED, content: Column | None = None) -> Column:
    """Hash that decides the side of a row: of its key, or of ``content`` if it has none."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    if content is None:
        content = F.lit("")
    return F.coalesce(hashed, F.md5(F.concat(F.lit(f"{seed}|"), content)))


def _cutoff(keys: DataFrame, test_size: float) -> Column:
    """The ``ceil(test_size * n)``-th smallest value of ``keys.k``, as a scalar.

    No global sort: a histogram over 65,536 prefixes finds the prefix that holds
    the cut, and only that prefix's keys are ranked.
    """
    prefix = F.substring("k", 1, _BUCKET_HEX_DIGITS)
    histogram = keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(1))
    wanted = F.ceil(F.sum("n").over(everything) * F.lit(test_size))
    cut = (
        histogram.select(
            "prefix", "n", F.sum("n").over(running).alias("upto"), wanted.alias("wanted")
        )
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select("prefix", (F.col("wanted") - F.col("upto") + F.col("n")).alias("rest"))
    )
    # keys are counted first: copies of one key never meet row by row
    in_cut = (
        keys.withColumn("prefix", prefix)
        .join(F.broadcast(cut), "prefix")
        .groupBy("prefix", "rest", "k")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    upto = F.sum("copies").over(
        Window.partitionBy("prefix").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = in_cut.withColumn("upto", upto).filter(F.col("upto") >= F.col("rest"))
    return reached.agg(F.min("k").alias("k")).scalar()


def mark_test_rows(
    df: DataFrame,
    key_col: str,
    test_size: float = fv.TEST_SIZE,
    seed: int = fv.SEED,
    exact: bool = True,
) -> DataFrame:
    """Add ``is_test`` for a reproducible split on ``key_col``.

    Exact: ``ceil(test_size * n)`` rows are test rows, those with the smallest
    hashed keys. Rows of one key stay together, so the number is exact for
    unique keys and may be larger by copies of the last one. Otherwise a row is
    a test row if its hash falls into the first ``test_size`` of the hash range:
    no statistics, and a row never changes sides as the table grows. A row
    without a key goes by its whole content, so no row is without a side.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    hashed = split_key(F.col(key_col), seed, content)
    if exact:
        cutoff = _cutoff(df.select(hashed.alias("k")), test_size)
        return df.withColumn("is_test", hashed <= cutoff)
    # 8 hex digits of the hash as a number in [0, 2^32)
    position = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", position < F.lit(int(test_size * 2**32)))


def train_test_split(
    df: DataFrame,
    key_col: str,
    test_size: float = fv.TEST_SIZE,
    seed: int = fv.SEED,
    exact: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: disjoint, and together all rows."""
    marked = mark_test_rows(df, key_col, test_size, seed, exact)
    train = marked.filter(~F.col("is_test")).drop("is_test")
    return train, marked.filter("is_test").drop("is_test")


def approx_tokens(text: Column, chars_per_token: float = 4.0) -> Column:
    """Token estimate from the number of characters, rounded up."""
    return F.ceil(F.length(text) / F.lit(chars_per_token)).cast("bigint")


def with_length_budget(
    df: DataFrame,
    text_col: str = "text",
    max_tokens: int = fv.MAX_SEQ_LENGTH,
    chars_per_token: float = 4.0,
) -> DataFrame:
    """Add ``approx_tokens`` and whether the text fits the trainer's sequence length."""
    estimate = approx_tokens(F.col(text_col), chars_per_token)
    return df.withColumn("approx_tokens", estimate).withColumn(
        "fits", F.col("approx_tokens") <= max_tokens
    )


def fit_messages(
    messages: Column, max_tokens: int = fv.MAX_SEQ_LENGTH, chars_per_token: float = 4.0
) -> Column:
    """The messages with the longest contents cut until the rendered text fits the budget.

    Number, order and roles of the turns stay. Contents longer than a common length are cut to
    it: a fold over the turns from the shortest on leaves those whole that need less than
    their share of what is left. If the tags alone are too long, all contents are empty.
    """
    length = lambda m: F.coalesce(F.length(m.getField("content")), F.lit(0))
    lengths = F.array_sort(F.transform(messages, length))
    # turns without content count too: the template leaves them out of the rendered text
    empty = F.transform(
        messages, lambda m: F.struct(m.getField("role").alias("role"), F.lit("").alias("content"))
    )
    tags = F.length(render_chat(empty))
    room = F.greatest(F.lit(int(max_tokens * chars_per_token)) - tags, F.lit(0))

    def keep_whole(state: Column, n: Column) -> Column:
        """Goes on while the next turn needs no more than its share; else settles the level."""
        left, turns, level = (state.getField(x) for x in ("left", "turns", "level"))
        fits = level.isNull() & (n * turns <= left)
        settled = F.when(level.isNull() & ~fits, F.floor(left / turns).cast("int")).otherwise(level)
        return F.struct(
            F.when(fits, left - n).otherwise(left).alias("left"),
            F.when(fits, turns - 1).otherwise(turns).alias("turns"),
            settled.alias("level"),
        )

    start = F.struct(
        room.cast("int").alias("left"),
        F.size(messages).alias("turns"),
        F.lit(None).cast("int").alias("level"),
    )
    level = F.aggregate(lengths, start, keep_whole, lambda state: state.getField("level"))

    def cut(m: Column) -> Column:
        content = m.getField("content")
        short = F.when(F.length(content) > level, F.substring(content, F.lit(1), level))
        return F.struct(
            m.getField("role").alias("role"), F.coalesce(short, content).alias("content")
        )

    return F.transform(messages, cut)
