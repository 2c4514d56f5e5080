"""Content-based recommendations and their precision and recall.

For a view the products are ranked by tier, then by catalogue position:

1. category is preferred by the user, 2. description contains a preferred
feature, 3. category of the viewed product, 4. all others.

Only the first ``k`` are wanted, so views are never paired with the catalogue.
``k + 1`` leading products of each category, of each feature and of the whole
catalogue suffice: whenever a later tier is reached, the tiers before it are
complete and hold fewer than ``k`` products, and they and the viewed product are
all that can be skipped in a list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tillwright.functions.numbers import share
from tillwright.operators.features import feature_texts
from tillwright.operators.ordering import running_totals
from tillwright.session import stored

PROFILE = ["preferred_categories", "preferred_features"]


@dataclass(frozen=True)
class Heads:
    """Leading products of the catalogue: per category, per description text, overall.

    ``picks`` are arrays of (pos, id) and the ``details`` asked for, and ``ids`` the ids alone, in catalogue order.
    """

    k: int
    by_category: DataFrame
    by_text: DataFrame
    overall: DataFrame
    details: tuple[str, ...] = ()

    def stored(self, path: str) -> Heads:
        """Write the three tables, so that micro-batches do not rescan the catalogue."""
        spark = self.by_category.sparkSession
        out = {}
        for name in ("by_category", "by_text", "overall"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = spark.read.parquet(f"{path}/{name}")
        return Heads(self.k, **out, details=self.details)


def _first_per(df: DataFrame, key: str, n: int, details: tuple[str, ...]) -> DataFrame:
    """(key, picks): the ``n`` leading products per key.  The rank limit acts before the shuffle too."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("pos", "id")))
    return _ordered(ranked.where(F.col("rank") <= n).groupBy(key), details)


def _ordered(grouped: GroupedData, details: tuple[str, ...]) -> DataFrame:
    picks = grouped.agg(F.sort_array(F.collect_list(F.struct("pos", "id", *_nested(details)))).alias("picks"))
    return picks.withColumn("ids", F.col("picks.id"))


def _nested(details: tuple[str, ...]) -> list[str]:
    return ["product"] if details else []


def catalogue_heads(catalogue: DataFrame, k: int, details: tuple[str, ...] = ()) -> Heads:
    """``catalogue`` has id, pos, category, description; ``pos`` is the catalogue order.

    A product listed more than once counts at its first place, so the ``k + 1`` leading rows are as many products.
    ``details`` are the columns that a recommended product is to have besides its id.
    """
    product = [F.struct(*[F.col(c) for c in details]).alias("product")] if details else []
    row = F.struct("pos", "category", F.lower("description").alias("text"), *product)
    products = catalogue.groupBy("id").agg(F.min(row).alias("first")).select("id", "first.*")
    return Heads(
        k=k,
        by_category=_first_per(products.where("category IS NOT NULL"), "category", k + 1, details),
        by_text=_first_per(products.where("text IS NOT NULL"), "text", k + 1, details),
        overall=_ordered(products.orderBy("pos", "id").limit(k + 1).groupBy(), details),
        details=details,
    )


def profiled(views: DataFrame) -> Column:
    """True when the view carries a profile and a user; user 0 counts as anonymous."""
    return F.coalesce(F.col("preferred_categories").isNotNull() & (F.col("user_id") != 0), F.lit(False))


def _profiles(views: DataFrame) -> DataFrame:
    """Views with ``has_profile`` and clean profile arrays, both NULL without profile."""
    none = F.array().cast("array<string>")
    has = profiled(views)
    return views.withColumn("has_profile", has).withColumns({
        "preferred_categories": F.when(has, F.coalesce("preferred_categories", none)),
        "preferred_features": F.when(has, F.transform(F.coalesce("preferred_features", none), F.lower)),
    })


def distinct_profiles(views: DataFrame, path: str | None = None) -> DataFrame:
    """The profiles that occur, stored: several joins below start from them, the views are read once for it.

    A stream gives the ``path``, so that its batches replace one another's profiles.
    """
    return stored(_profiles(views).where("has_profile").select(*PROFILE).distinct(), "profiles", path)


def _distinct_features(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.explode("preferred_features").alias("feature")).where("feature IS NOT NULL").distinct()


def feature_heads(pairs: DataFrame, heads: Heads) -> DataFrame:
    """(feature, picks) of the features found in texts; ``pairs`` (feature, text) come from ``feature_texts``."""
    picks = pairs.join(heads.by_text.select("text", "picks"), "text").select("feature", F.inline("picks"))
    return _first_per(picks, "feature", heads.k + 1, heads.details)


def liked_lists(profiles: DataFrame, heads: Heads, by_feature: DataFrame) -> DataFrame:
    """Each distinct profile with its ``k + 1`` leading products of tiers 1 and 2, as ``liked_ids`` and ``liked_picks``."""

    def tier(n: int) -> Column:
        kept = ["pos", "id", *_nested(heads.details)]
        return F.transform("picks", lambda p: F.struct(F.lit(n).alias("tier"), *[p[c].alias(c) for c in kept]))

    liked = (
        profiles.select(*PROFILE, F.explode("preferred_categories").alias("category"))
        .join(heads.by_category, "category").select(*PROFILE, tier(1).alias("picks"))
    )
    described = (
        profiles.select(*PROFILE, F.explode("preferred_features").alias("feature"))
        .join(by_feature, "feature").select(*PROFILE, tier(2).alias("picks"))
    )
    # a group holds one short list per category and feature of the profile
    return (
        liked.unionByName(described).groupBy(*PROFILE)
        .agg(F.sort_array(F.flatten(F.collect_list("picks"))).alias("liked_picks"))
        .withColumn("liked_ids", F.slice(F.array_distinct(F.col("liked_picks.id")), 1, heads.k + 1))
    )


def _liked_products(profiles: DataFrame, heads: Heads) -> DataFrame:
    texts = heads.by_text.select("text")
    return liked_lists(profiles, heads, feature_heads(feature_texts(_distinct_features(profiles), texts), heads))


def recommend(views: DataFrame, heads: Heads, profiles: DataFrame | None = None, liked: DataFrame | None = None) -> DataFrame:
    """Views with ``has_profile``, ``recs`` and ``liked_recs``, and ``products`` if the heads have details.

    ``recs`` holds up to ``k`` product ids; the first ``liked_recs`` of them are of
    tiers 1 and 2, which are the products relevant to the user.  ``views`` has
    user_id, product_id, category (of the viewed product) and the profile arrays,
    NULL for a view without profile.  ``profiles`` are their distinct profiles, if
    the caller has them, ``liked`` their lists (``liked_lists``).
    """
    liked = _liked_products(profiles or distinct_profiles(views), heads) if liked is None else liked
    views = _profiles(views)
    return _ranked(views.join(liked, PROFILE, "left"), views.columns, heads)


def _ranked(views: DataFrame, keep: list[str], heads: Heads) -> DataFrame:
    """Chain the lists: liked, viewed category, catalogue; each product counts at its first place."""
    viewed = F.col("product_id")
    chain = F.array_distinct(F.concat(
        F.coalesce("liked_ids", F.array()), F.coalesce("ids", F.array()), F.coalesce("overall_ids", F.array())))
    others = F.when(viewed.isNull(), chain).otherwise(F.array_remove(chain, viewed))
    ranked = (
        views.join(heads.by_category.select("category", "ids", *([F.col("picks").alias("alike")] if heads.details else [])),
                   "category", "left")
        .withColumn("overall_ids", heads.overall.select("ids").scalar())
        .withColumn("recs", F.slice(others, 1, heads.k))
        .withColumn("liked_recs", F.size(F.array_intersect("recs", F.coalesce("liked_ids", F.array()))))
    )
    if not heads.details:
        return ranked.select(*keep, "recs", "liked_recs")
    # a subquery can't stand within a function over an array, so its result gets a name first
    ranked = ranked.withColumn("every", heads.overall.select("picks").scalar())
    known = [F.coalesce(F.transform(c, lambda p: F.struct(p["id"].alias("id"), p["product"].alias("product"))), F.array())
             for c in ("liked_picks", "alike", "every")]
    ranked = ranked.withColumn("known", F.concat(*known))
    whole = F.transform("recs", lambda r: F.element_at(F.filter("known", lambda p: p["id"] == r), 1)["product"])
    return ranked.withColumn("products", whole).select(*keep, "recs", "liked_recs", "products")


def same_category(views: DataFrame, heads: Heads) -> DataFrame:
    """The same without regard to profiles: the viewed category, then the others."""
    none = views.withColumn("liked_ids", F.array().cast("array<bigint>"))
    if heads.details:
        none = none.withColumn("liked_picks", F.lit(None).cast(heads.overall.schema["picks"].dataType))
    return _ranked(none, views.columns, heads)


def rec_rows(recs: DataFrame, *keep: str) -> DataFrame:
    """One row per recommendation: the kept columns, rank, rec_id, relevant."""
    return recs.select(*keep, "liked_recs", F.posexplode("recs").alias("pos", "rec_id")).select(
        *keep, (F.col("pos") + 1).alias("rank"), "rec_id", (F.col("pos") < F.col("liked_recs")).alias("relevant"))


def is_relevant(category: str = "category", description: str = "description") -> Column:
    """Would the user of this row like its product: category preferred, or a feature in the description."""
    text = F.lower(F.coalesce(F.col(description), F.lit("")))
    liked = F.coalesce(F.array_contains("preferred_categories", F.col(category)), F.lit(False))
    described = F.coalesce(F.exists("preferred_features", lambda f: F.contains(text, F.lower(f))), F.lit(False))
    return liked | described


def numbered_products(catalogue: DataFrame) -> DataFrame:
    """(n, category, text), stored: the numbers are consecutive within a partition, so bitmaps over them are dense."""
    products = catalogue.select("category", F.lower("description").alias("text"))
    return stored(products.select((F.monotonically_increasing_id() + 1).alias("n"), "*"), "numbered-products")


def _bitmaps(rows: DataFrame, kind: str, key: str) -> DataFrame:
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    return rows.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.bitmap_bucket_number("n").alias("bucket")).agg(bits)


def category_bitmaps(numbered: DataFrame) -> DataFrame:
    """(kind, key, bucket, bits): the products of each category, a bit each, in buckets of 32,768 numbers."""
    return _bitmaps(numbered.where("category IS NOT NULL"), "category", "category")


def feature_bitmaps(numbered: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same for the products whose text has a feature; ``pairs`` (feature, text) come from ``feature_texts``."""
    return _bitmaps(numbered.select("n", "text").join(pairs, "text"), "feature", "feature")


def united_counts(profiles: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(profile, relevant_products): how many products are in one of the profile's categories or have one of its features."""
    def keys(kind: str, column: str) -> DataFrame:
        return profiles.select(*PROFILE, F.lit(kind).alias("kind"), F.explode(F.array_distinct(column)).alias("key"))

    wanted = keys("category", "preferred_categories").unionByName(keys("feature", "preferred_features"))
    united = wanted.join(bitmaps, ["kind", "key"]).groupBy(*PROFILE, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return united.groupBy(*PROFILE).agg(F.sum("n").alias("relevant_products"))


def relevant_counts(profiles: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(profile, relevant_products): catalogue products each distinct profile would like.

    The union of the profile's categories and features is taken on bitmaps, so a product in several of them
    counts once and profiles never meet products: a key costs a row per 32,768 products, however many have it.
    """
    numbered = numbered_products(catalogue)
    texts = numbered.select("text").where("text IS NOT NULL").distinct()
    pairs = feature_texts(_distinct_features(profiles), texts)
    return united_counts(profiles, category_bitmaps(numbered).unionByName(feature_bitmaps(numbered, pairs)))


COUNTERS = ["total_recommendations", "relevant_recommendations", "total_relevant_products"]


def event_counters(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """Profiled views with the recommendations made, those relevant, and the products relevant to the user.

    ``relevant`` comes from ``relevant_counts`` for the profiles of these views.
    """
    return recs.where("has_profile").join(relevant, PROFILE, "left").select(
        "event_id", "timestamp", "user_id",
        F.size("recs").cast("bigint").alias("total_recommendations"),
        F.col("liked_recs").cast("bigint").alias("relevant_recommendations"),
        F.coalesce("relevant_products", F.lit(0)).alias("relevant_products"),
    )


def user_counters(counters: DataFrame) -> DataFrame:
    """Per user the sums, with relevant products counted once: at the first view that has any."""
    first = F.min(F.when(F.col("relevant_products") > 0, F.struct("timestamp", "event_id", "relevant_products")))
    return counters.groupBy("user_id").agg(
        F.sum("total_recommendations").alias("total_recommendations"),
        F.sum("relevant_recommendations").alias("relevant_recommendations"),
        first.alias("first"),
    ).select("*", F.coalesce("first.relevant_products", F.lit(0)).alias("total_relevant_products"))


def scored(df: DataFrame, *keep: str) -> DataFrame:
    """Precision, recall and F1 of rows that have the ``COUNTERS``; zero where there is nothing to divide by."""
    ratio = {
        "precision": share("relevant_recommendations", "total_recommendations"),
        "recall": share("relevant_recommendations", "total_relevant_products"),
    }
    df = df.withColumns({n: F.coalesce(c, F.lit(0.0)) for n, c in ratio.items()})
    f1 = share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return df.select(*keep, "precision", "recall", F.coalesce(f1, F.lit(0.0)).alias("f1"), *COUNTERS)


def metrics_by_user(counters: DataFrame) -> DataFrame:
    """(user_id, precision, recall, f1, counters)."""
    return scored(user_counters(counters), "user_id")


def metrics_overall(counters: DataFrame) -> DataFrame:
    """One row over all users; recall can exceed 1, since views repeat and relevant products do not."""
    totals = user_counters(counters).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
    return scored(totals)


def history_chunks(events: DataFrame, size: int = 1000) -> DataFrame:
    """(user_id, kind, chunk, product_ids): each user's products in event order, ``size`` ids per row.

    ``events`` has user_id, kind, timestamp, event_id, product_id.  Positions come
    from distributed running totals and rows hold at most ``size`` ids, so a user
    with any number of events is spread over tasks and rows.
    """
    placed = running_totals(events, ["user_id", "kind"], ["timestamp", "event_id"], {"position": F.lit(1)})
    chunk = F.floor((F.col("position") - 1) / size)
    return (
        placed.groupBy("user_id", "kind", chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "product_id"))).alias("rows"))
        .select("user_id", "kind", "chunk", F.col("rows.product_id").alias("product_ids"))
    )
