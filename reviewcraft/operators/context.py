"""Per-place contexts: minimum size, score, rating-proportional sample, ordered text.

Places differ in size by orders of magnitude, and one may hold a large share of all reviews.
Texts are therefore left where they are until the sample is known:

1. Counts by place and rating are combined before their shuffle; they give the sample sizes.
2. Reviews are ranked as narrow rows (keys, score, a hash of the text). The literal bound on the
   rank lets Spark cut each input task's rows to that many a rating before the shuffle, so a
   place of any size sends few.
3. The chosen keys, a bounded number a place, fetch their texts by a join. Spark broadcasts
   them if they are few, or prunes the scan with a filter made of them.

The input is read three times, two of them without most of its bytes: it should be a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx

@dataclass(frozen=True)
class ContextParams:
    max_reviews: int = fv.MAX_REVIEWS_PER_PLACE
    min_reviews: int = fv.MIN_REVIEWS_PER_PLACE
    ideal_min_words: int = fv.IDEAL_MIN_WORDS
    ideal_max_words: int = fv.IDEAL_MAX_WORDS
    text_col: str = "cleaned_text"
    id_col: str = "review_id"
    seed: int = fv.SEED
    line_prefix: str = fv.LINE_PREFIX
    line_middle: str = fv.LINE_MIDDLE
    # tuning, without effect on results: above 1, input tasks are dealt into so many groups
    # that are ranked on their own first; for clusters with very many tasks
    salts: int = 1


def with_review_id(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Give rows without an id one made of their content.

    Equal rows get equal ids, which is harmless here: they are interchangeable.
    """
    if id_col in df.columns:
        return df
    content = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.withColumn(id_col, F.sha2(content, 256))


# --- counts and scores -------------------------------------------------------


def place_counts(df: DataFrame, min_reviews: int = fv.MIN_REVIEWS_PER_PLACE) -> DataFrame:
    """Distinct places before and after the minimum, and how many it removes."""
    per_place = df.filter(F.col("place_id").isNotNull()).groupBy("place_id").count()
    large = F.count_if(F.col("count") >= min_reviews)
    return per_place.agg(
        F.count(F.lit(1)).alias("initial_places"),
        large.alias("kept_places"),
        (F.count(F.lit(1)) - large).alias("removed_places"),
    )


#: Registers of a sketch are 2 to this power; its standard error is 1.04 / sqrt of their number.
SKETCH_BITS = 14


def place_sketches(df: DataFrame, *by: str) -> DataFrame:
    """A sketch of the distinct places of each group ``by`` (a run, a day), to be stored.

    Sketches of a few kilobytes take the place of the reviews: those of any runs merge into
    that of all of them, without reading a review again.
    """
    sketch = F.hll_sketch_agg(F.col("place_id").cast("string"), F.lit(SKETCH_BITS))
    return df.filter(F.col("place_id").isNotNull()).groupBy(*by).agg(sketch.alias("places"))


def approx_places(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated number of distinct places over all sketches, or for each group ``by``."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("places")).alias("approx_places")
    )


def filter_min_reviews(
    df: DataFrame, min_reviews: int = fv.MIN_REVIEWS_PER_PLACE
) -> DataFrame:
    """Reviews of places that have at least ``min_reviews``.

    Counts are combined before the shuffle. If the semi join cannot broadcast,
    adaptive execution splits an oversized place across tasks.
    """
    large = (
        df.groupBy("place_id").count().filter(F.col("count") >= min_reviews).select("place_id")
    )
    return df.join(large, "place_id", "left_semi")


def with_info_score(df: DataFrame, params: ContextParams = ContextParams()) -> DataFrame:
    """Add ``word_count`` and ``info_score``: short reviews count half, long ones are capped."""
    words = F.col("word_count")
    score = (
        F.when(words < params.ideal_min_words, words * F.lit(fv.SHORT_REVIEW_FACTOR))
        .when(words > params.ideal_max_words, F.lit(float(params.ideal_max_words)))
        .otherwise(words.cast("double"))
    )
    return df.withColumn("word_count", tx.word_count(F.col(params.text_col))).withColumn(
        "info_score", score
    )


def _allocation(n_rating: Column, n_rated: Column, params: ContextParams) -> Column:
    """Sample size of one rating: its share of the maximum, rounded half to even."""
    share = n_rating / F.nullif(n_rated, F.lit(0))
    return F.rint(share * params.max_reviews)


def rating_allocations(df: DataFrame, params: ContextParams = ContextParams()) -> DataFrame:
    """Per place and rating: number of reviews, share, and sample size."""
    per_rating = (
        df.filter(F.col("place_id").isNotNull() & F.col("rating").isNotNull())
        .groupBy("place_id", "rating")
        .agg(F.count(F.lit(1)).alias("n_rating"))
    )
    # one row per rating is left of each place, so this window stays small
    total = F.sum("n_rating").over(Window.partitionBy("place_id"))
    return per_rating.withColumn("n_rated", total).select(
        "place_id",
        "rating",
        "n_rating",
        (F.col("n_rating") / F.col("n_rated")).alias("share"),
        _allocation(F.col("n_rating"), F.col("n_rated"), params).cast("int").alias("alloc"),
    )


def place_metadata(df: DataFrame, params: ContextParams = ContextParams()) -> DataFrame:
    """One row per place: name, number of reviews, average rating to two places."""
    return (
        df.filter(F.col("place_id").isNotNull())
        .groupBy("place_id")
        .agg(
            F.min_by("place_name", _named_id(params)).alias("place_name"),
            F.count(F.lit(1)).alias("total_reviews_analyzed"),
            _round2(F.avg("rating")).alias("avg_rating"),
        )
    )


def _named_id(params: ContextParams) -> Column:
    """The id of rows with a name: its minimum belongs to the first non-null name."""
    return F.when(F.col("place_name").isNotNull(), F.col(params.id_col))


def _round2(value: Column) -> Column:
    return F.rint(value * 100) / 100


# --- sampling ----------------------------------------------------------------


def _place_tables(df: DataFrame, params: ContextParams) -> tuple[DataFrame, DataFrame]:
    """Places with enough reviews and their metadata; sample sizes by place and rating."""
    per_rating = df.groupBy("place_id", "rating").agg(
        F.count(F.lit(1)).alias("n_rating"),
        F.min_by("place_name", _named_id(params)).alias("name"),
        F.min(_named_id(params)).alias("named_id"),
    )
    rated = F.col("rating").isNotNull()
    places = (
        per_rating.groupBy("place_id")
        .agg(
            F.sum("n_rating").alias("n_reviews"),
            F.coalesce(F.sum(F.when(rated, F.col("n_rating"))), F.lit(0)).alias("n_rated"),
            F.sum(F.col("rating") * F.col("n_rating")).alias("rating_sum"),
            F.min_by("name", "named_id").alias("place_name"),
        )
        .filter(F.col("n_reviews") >= params.min_reviews)
    )
    allocation = _allocation(F.col("n_rating"), F.col("n_rated"), params)
    small = F.col("n_reviews") <= params.max_reviews
    bounds = (
        per_rating.filter(rated)
        .join(places.select("place_id", "n_reviews", "n_rated"), "place_id")
        .withColumn("bound", F.when(small, F.lit(params.max_reviews)).otherwise(allocation))
        .filter(F.col("bound") >= 1)
        .select("place_id", "rating", "bound")
    )
    return places, bounds


def _review_keys(params: ContextParams) -> list[str]:
    """What tells reviews apart; reviews that agree in all of it are copies of each other."""
    return ["place_id", "rating", params.id_col, "mark"]


def _marked(df: DataFrame, params: ContextParams) -> DataFrame:
    return df.filter(F.col("rating").isNotNull()).withColumn("mark", F.xxhash64(params.text_col))


def _picks(df: DataFrame, bounds: DataFrame, params: ContextParams) -> DataFrame:
    """Narrow rows of the sample: keys, scores, and ``rn``, the rank in place and rating."""
    keys = _review_keys(params)
    rows = with_info_score(_marked(df, params), params).select(*keys, "word_count", "info_score")
    order = [F.col("info_score").desc_nulls_last(), F.col(params.id_col).asc(), F.col("mark")]
    if params.salts > 1:
        salted = Window.partitionBy("place_id", "rating", "salt").orderBy(*order)
        rows = (
            rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(params.salts)))
            .withColumn("rn", F.row_number().over(salted))
            .filter(F.col("rn") <= params.max_reviews)
        )
    whole = Window.partitionBy("place_id", "rating").orderBy(*order)
    # the sample sizes come after the cut: a join in front of it would move all rows
    return (
        rows.withColumn("rn", F.row_number().over(whole))
        .filter(F.col("rn") <= params.max_reviews)
        .join(bounds, ["place_id", "rating"])
        .filter(F.col("rn") <= F.col("bound"))
        .select(*keys, "word_count", "info_score", "rn")
    )


def _sample_columns(params: ContextParams) -> list[str]:
    return ["place_id", params.id_col, "rating", "word_count", "info_score", "rn", params.text_col]


def sample_reviews(df: DataFrame, params: ContextParams = ContextParams()) -> DataFrame:
    """The reviews that go into the contexts, one row each, ``rn`` being the rank in its rating."""
    df = df.filter(F.col("place_id").isNotNull())
    keys = _review_keys(params)
    copies = _picks(df, _place_tables(df, params)[1], params).groupBy(*keys).agg(
        F.collect_list(F.struct("word_count", "info_score", "rn")).alias("picked")
    )
    texts = (
        _marked(df, params)
        .select(*keys, params.text_col)
        .join(copies, keys)
        .groupBy(*keys)
        .agg(F.first(params.text_col).alias(params.text_col), F.first("picked").alias("picked"))
    )
    return texts.select("*", F.inline("picked")).select(*_sample_columns(params))


# --- text --------------------------------------------------------------------


def review_line(params: ContextParams = ContextParams()) -> Column:
    """One review as a bullet with its rating cut to a whole number."""
    stars = F.col("rating").cast("int").cast("string")
    return F.concat(
        F.lit(params.line_prefix), stars, F.lit(params.line_middle), F.col(params.text_col)
    )


def _joined_lines(params: ContextParams) -> Column:
    """Aggregate: lines in a fixed pseudo-random order; at most 2 * max_reviews of them.

    Copies of a review come as one entry that says how many of them were picked.
    """
    key = F.md5(F.concat(F.lit(f"{params.seed}:"), F.col(params.id_col).cast("string")))
    entry = F.struct(key.alias("key"), review_line(params).alias("line"), "mark", "copies")
    repeated = F.transform(
        F.array_sort(F.collect_set(entry)), lambda x: F.array_repeat(x["line"], x["copies"])
    )
    return F.array_join(F.flatten(repeated), "\n")


def build_context(df: DataFrame, params: ContextParams = ContextParams()) -> DataFrame:
    """One context per place with enough reviews.

    ``df`` needs ``place_id, place_name, rating``, the text column and an id
    that decides ties (``with_review_id``).
    """
    df = df.filter(F.col("place_id").isNotNull())
    places, bounds = _place_tables(df, params)
    keys = _review_keys(params)
    picked = _picks(df, bounds, params).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )
    contexts = (
        _marked(df, params)
        .select(*keys, params.text_col)
        .join(picked, keys)
        .groupBy("place_id")
        .agg(_joined_lines(params).alias("llm_input_context"))
    )
    # a place may have no sample: every rating too rare, or none at all
    return places.join(contexts, "place_id", "left").select(
        "place_id",
        F.coalesce("llm_input_context", F.lit("")).alias("llm_input_context"),
        "place_name",
        F.col("n_reviews").alias("total_reviews_analyzed"),
        _round2(F.col("rating_sum") / F.nullif("n_rated", F.lit(0))).alias("avg_rating"),
    )
