"""Which texts contain which features, as a join on the rarest piece of each feature.

A feature is looked up by one of its pieces: the one that occurs in the fewest texts.  So a feature that begins like half of
the catalogue still meets few candidates.  Pieces have the largest of ``SIZES`` characters that the feature has: four characters
are in so many texts that long features would meet most of them.  Pieces that are in more than
one text of ``HOT`` are spread over several keys.  Candidates are tested on the text itself.

The texts are first cut to what can hold a feature: runs of the characters that occur in features, as long as the shortest feature.
Every distinct run is searched once, and the texts themselves are not shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stored

SIZES = (1, 2, 3, 4, 6, 8, 12)
PIECE, LONGEST = 4, SIZES[-1]
HOT = 100
SALTS = 64
# features of more characters: a text is one run, since a class of so many would be tested character by character
ALPHABET = 256


def _pieces(text: Column, size: Column) -> Column:
    """The distinct pieces of ``size`` characters; the empty piece for size 0.

    A look-ahead at every place takes time in proportion to the text; substrings by number would count from its start each time.
    """
    ahead = F.concat(F.lit("(?s)(?=(.{"), size.cast("string"), F.lit("}))"))
    every = F.array_distinct(F.regexp_extract_all(text, ahead, F.lit(1)))
    return F.when(size == 0, F.array(F.lit(""))).otherwise(every)


def _piece_size(feature: Column, piece: int) -> Column:
    """The largest of ``SIZES`` up to ``piece`` that the feature has; 0 for the empty feature."""
    sizes = [n for n in SIZES if n < piece] + [piece]
    return F.greatest(F.lit(0), *[F.when(F.length(feature) >= n, n) for n in sizes])


def rarest_pieces(features: DataFrame, text_pieces: DataFrame, piece: int = PIECE) -> DataFrame:
    """(feature, piece, n): the piece of each feature that the fewest texts have, and how many have it.

    ``text_pieces`` (mark, piece) has a row per text and distinct piece.  Features with a piece that no text has are left out.
    """
    size = _piece_size(F.col("feature"), piece)
    own = features.select("feature", F.explode(_pieces(F.col("feature"), size)).alias("piece"))
    counts = text_pieces.join(own.select("piece").distinct(), "piece").groupBy("piece").agg(F.count("*").alias("n"))
    least = own.join(counts, "piece", "left").groupBy("feature").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("least"))
    return least.where("least.n > 0").select("feature", "least.piece", "least.n")


def feature_candidates(features: DataFrame, marked: DataFrame, piece: int = LONGEST) -> DataFrame:
    """(feature, mark) of the texts (mark, text) that have the feature's rarest piece.

    A text is cut into the lengths that occur among the features, which a scalar subquery tells, so planning runs
    no job over the texts.  The texts are cut once: the pieces that some feature has are stored.  The pieces that are hot and chosen are told
    by another scalar subquery; there are at most ``HOT`` times as many as a text has pieces on average.
    """
    size = _piece_size(F.col("feature"), piece)
    sizes = features.agg(F.collect_set(size).alias("sizes")).scalar()
    cut = F.array_distinct(F.flatten(F.transform("sizes", lambda n: _pieces(F.col("text"), n))))
    # stored, so that its size is known: few wanted pieces are sent to the texts, whose pieces then don't move
    own = stored(features.select(F.explode(_pieces(F.col("feature"), size)).alias("piece")).distinct(), "wanted-pieces")
    pieces = stored(marked.withColumn("sizes", sizes).select("mark", F.explode(cut).alias("piece")).join(own, "piece", "left_semi"), "pieces")
    chosen = stored(rarest_pieces(features, pieces, piece), "feature-pieces")
    share = F.col("n") * HOT / marked.agg(F.count("*")).scalar()
    salts = F.when(share > 1, F.least(F.lit(SALTS), F.ceil(share))).otherwise(1).cast("int")
    chosen = chosen.withColumn("salts", salts)
    hot = chosen.where("salts > 1").select("piece", "salts").distinct().agg(
        F.map_from_entries(F.collect_list(F.struct("piece", "salts"))).alias("hot")).scalar()
    salt = F.pmod("mark", F.coalesce(F.try_element_at(hot, F.col("piece")), F.lit(1))).cast("int")
    wanted = chosen.select("feature", "piece", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return pieces.withColumn("salt", salt).join(wanted, ["piece", "salt"]).select("feature", "mark")


def _run_pattern(features: DataFrame) -> Column:
    """A pattern of the runs that can hold a feature: characters of the features, at least as many as the shortest has."""
    shortest, characters = F.min(F.length("feature")), F.array_distinct(F.flatten(F.collect_set(F.array_distinct(F.split("feature", "")))))
    known = features.agg(shortest.alias("n"), characters.alias("characters"))
    codes = F.transform("characters", lambda c: F.concat(F.lit("\\x{"), F.hex(F.ascii(c)), F.lit("}")))
    one = F.when(F.size("characters") > ALPHABET, "(?s:.)").otherwise(
        F.concat(F.lit("[\\x{0}"), F.array_join(codes, ""), F.lit("]")))
    return known.select(F.concat(one, F.lit("{"), F.col("n").cast("string"), F.lit(",}+"))).scalar()


def feature_texts(features: DataFrame, texts: DataFrame, piece: int = LONGEST, carried: Sequence[str] = ()) -> DataFrame:
    """(feature, text) for every text that contains the feature; both inputs hold distinct values, lower-case alike.

    With ``carried``, columns of ``texts``, the result has them in place of the text, and no join or exchange carries texts.
    """
    features = stored(features.where("feature IS NOT NULL"), "features")
    row = F.monotonically_increasing_id() if carried else F.xxhash64("text")
    cut = texts.withColumn("pattern", _run_pattern(features)).select(
        row.alias("row"), *carried, F.explode(F.array_distinct(F.regexp_extract_all("text", F.col("pattern"), F.lit(0)))).alias("run"))
    cut = stored(cut, "runs")
    runs = stored(cut.select("run").distinct().select(F.monotonically_increasing_id().alias("mark"), F.col("run").alias("text")), "distinct-runs")
    within = feature_candidates(features, runs, piece).join(runs, "mark").where(F.contains("text", "feature")).select("feature", "mark")
    numbered = cut.join(runs.withColumnRenamed("text", "run"), "run").drop("run")
    # a feature can be in several runs of a text
    found = numbered.join(within, "mark").select("feature", "row", *carried).distinct()
    if carried:
        return found.drop("row")
    marked = texts.select("text", F.xxhash64("text").alias("row"))
    return found.join(marked, "row").where(F.contains("text", "feature")).select("feature", "text")


def with_features(texts: DataFrame, features: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``text`` contains a feature, with those features, sorted, as ``found``."""
    pairs = feature_texts(features, texts.select("text").where("text IS NOT NULL").distinct())
    return texts.join(pairs.groupBy("text").agg(F.sort_array(F.collect_set("feature")).alias("found")), "text")
