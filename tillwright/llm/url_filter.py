r"""URLs allowed or blocked by rules, and by the ratio of two character models where no rule fits.

``parsed`` cuts a URL into host and path.  ``ruled`` finds the longest rule that fits: host or a parent domain equal, path
beginning equal.  The URLs that rules decide are the examples of two variable-order Markov models over characters,
one of the accepted and one of the rejected.  A character's probability after the ``ORDER`` characters before it
is interpolated with those after fewer (Witten and Bell): an order weighs as much as its context was seen often
with few different followers, so the order in effect varies with the evidence.  A URL's score is the difference
of the two log-likelihoods per character.  Examples with a certain digest are left out of the counts;
their scores by class calibrate: two normal curves with one variance give the log-odds of rejection.

Only DataFrame operations: addresses are folded first (letters in lower case, digit runs one digit, rare characters
one sign), so there are ``CHARACTERS`` (40) of them, and at most 40 ** (ORDER + 1) grams, whatever the input.  Equal folded
addresses are scored once, with their number as weight in all counts.  Weights are integers (millionths of a
natural logarithm), so sums don't depend on the order of addition and reruns agree.  No side is broadcast by hint: grams
meet their weights in a join that adaptive execution broadcasts if it is small and splits if a gram is hot.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed, as is every
URL without a rule while one of the two classes has no example; rules may be without hosts or paths (then they fit all);
repeated rows and ids all stay; very long URLs are scored whole; an empty table gives no rows; other columns of the
input are kept out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stored

ORDER = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEPT = LOWER + "0./-_~%=&+:"  # after folding; any other character becomes "?"
BEGIN, END = "^", "$"
CHARACTERS = len(KEPT) + 3
HELD_OUT = "33"  # examples whose digest begins below this, a fifth of them, calibrate
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host and the beginning of a path, as ``example.com/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host):]


RULES = (Rule(ALLOW, "com/"), Rule(BLOCK, "example.com/en/"), Rule(ALLOW, "www.example.com/en/"), Rule(BLOCK, "net/es/"),
         Rule(BLOCK, "net/fr/"))


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _fits(rule: Rule) -> Column:
    host = F.lit(True) if not rule.host else (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
    return host & F.startswith("path", F.lit(rule.path))


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), rule and verdict null where no rule fits."""
    host, path = parsed(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    first = F.coalesce(*[
        F.when(_fits(r), F.struct(F.lit(r.pattern).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))])
    return rows.withColumn("found", first).select("page_id", "host", "path", "found.rule", "found.verdict")


def folded(text: Column) -> Column:
    lower = F.regexp_replace(F.translate(text, UPPER, LOWER), "[0-9]+", "0")
    return F.regexp_replace(lower, f"[^{LOWER}0./_~%=&+:-]", "?")


def _grams(address: Column) -> Column:
    """Each character of the address and its end, with the ``ORDER`` characters before it."""
    padded = F.concat(F.lit(BEGIN * ORDER), address, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(address) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def gram_counts(addresses: DataFrame) -> DataFrame:
    """(gram, accepted, rejected): grams of 1 to ``ORDER + 1`` characters of the examples, counted per class."""
    whole = addresses.select(F.explode(_grams(F.col("address"))).alias("gram"), "accepted", "rejected").groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    shorter = F.array(*[F.right("gram", F.lit(n)) for n in range(1, ORDER + 2)])
    return whole.select(F.explode(shorter).alias("gram"), "accepted", "rejected").groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def gram_weights(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, weight) for the ``wanted`` grams: ln P(last | rest; rejected) - ln P(last | rest; accepted), in millionths."""
    context = F.expr("left(gram, length(gram) - 1)")
    contexts = counts.groupBy(context.alias("context")).agg(*[
        f.alias(f"{n}_{c}") for c in ("accepted", "rejected") for n, f in (("n", F.sum(c)), ("kinds", F.count_if(F.col(c) > 0)))])
    steps = wanted.select(F.col("gram").alias("whole"), F.explode(F.array(*[F.lit(n) for n in range(1, ORDER + 2)])).alias("size"))
    steps = steps.withColumn("gram", F.expr("right(whole, size)")).withColumn("context", context)
    found = steps.join(contexts, "context", "left").join(counts, "gram", "left").groupBy("whole").agg(
        F.sort_array(F.collect_list(F.struct("size", "accepted", "rejected", "n_accepted", "n_rejected",
                                             "kinds_accepted", "kinds_rejected"))).alias("steps"))

    def probability(c: str) -> Column:
        none = F.lit(0).cast("double")
        return F.aggregate("steps", F.lit(1.0 / CHARACTERS), lambda p, s: F.when(
            F.coalesce(s[f"n_{c}"], F.lit(0)) > 0,
            (F.coalesce(s[c].cast("double"), none) + s[f"kinds_{c}"] * p) / (s[f"n_{c}"] + s[f"kinds_{c}"])).otherwise(p))

    ratio = F.log(probability("rejected")) - F.log(probability("accepted"))
    return found.select(F.col("whole").alias("gram"), F.round(ratio * 1e6).cast("long").alias("weight"))


def address_scores(addresses: DataFrame) -> DataFrame:
    """``addresses`` with ``score``, the log-likelihood difference per character; null without both classes.

    ``addresses`` (number, address, accepted, rejected, open) is a stored table, a row per folded address.
    """
    grams = addresses.select("number", F.explode(_grams(F.col("address"))).alias("gram"))
    examples = addresses.where(f"accepted + rejected > 0 AND NOT {held_out()}")
    asked = addresses.where(f"open > 0 OR {held_out()}")
    weights = gram_weights(gram_counts(examples), asked.select(F.explode(_grams(F.col("address"))).alias("gram")).distinct())
    sums = grams.join(weights, "gram").groupBy("number").agg((F.sum("weight") / F.count("*") / 1e6).alias("score"))
    both = examples.agg((F.coalesce(F.sum("accepted") > 0, F.lit(False)) & F.coalesce(F.sum("rejected") > 0, F.lit(False)))).scalar()
    return asked.join(sums, "number").select(
        "address", "accepted", "rejected", "open", F.when(both & (F.col("address") != ""), F.col("score")).alias("score"))


def held_out() -> str:
    return f"(substr(md5(address), 1, 2) < '{HELD_OUT}')"


def calibration(scored: DataFrame) -> DataFrame:
    """One row: the log-odds of rejection are ``slope`` * score + ``shift``.

    From the held-out examples, as two normal curves of one variance and the classes' shares.  Without examples of both
    classes, or where they don't differ in the expected direction, the score itself is taken.
    """
    by = {"a": "accepted", "r": "rejected"}
    sums = scored.where(held_out()).where("score IS NOT NULL").agg(
        *[f.alias(f"{n}{k}") for k, c in by.items() for n, f in (
            ("n", F.sum(c)), ("s", F.sum(F.col(c) * F.col("score"))), ("q", F.sum(F.col(c) * F.col("score") * F.col("score"))))])
    known = (F.col("na") > 0) & (F.col("nr") > 0)
    means = sums.withColumns({f"m{k}": F.when(known, F.col(f"s{k}") / F.col(f"n{k}")) for k in by})
    spread = (F.col("qa") - F.col("sa") * F.col("ma") + F.col("qr") - F.col("sr") * F.col("mr")) / (F.col("na") + F.col("nr"))
    means = means.withColumn("v", F.greatest(spread, F.lit(1e-4)))
    usable = F.coalesce(known & (F.col("mr") > F.col("ma")), F.lit(False))
    return means.select(
        F.when(usable, (F.col("mr") - F.col("ma")) / F.col("v")).otherwise(1.0).alias("slope"),
        F.when(usable, (F.col("ma") * F.col("ma") - F.col("mr") * F.col("mr")) / (2 * F.col("v"))
               + F.log(F.col("nr") / F.col("na"))).otherwise(0.0).alias("shift"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, rejection): ``rejection`` is the models' probability, null where a rule decides.

    ``pages`` has page_id and url.
    """
    rows = ruled(pages, rules).withColumn("address", folded(F.concat("host", "path")))
    addresses = rows.groupBy("address").agg(
        F.count_if(F.col("verdict") == ALLOW).alias("accepted"), F.count_if(F.col("verdict") == BLOCK).alias("rejected"),
        F.count_if(F.col("verdict").isNull()).alias("open"))
    # written, so that the numbers are the same in every pass
    addresses = stored(addresses.withColumn("number", F.monotonically_increasing_id()), "addresses")
    scored = stored(address_scores(addresses), "address-scores")
    fitted = calibration(scored)
    odds = fitted.select("slope").scalar() * F.col("score") + fitted.select("shift").scalar()
    judged = scored.where("open > 0").select("address", odds.alias("odds"))
    own = F.when(F.coalesce(F.col("odds") > 0, F.lit(False)), BLOCK).otherwise(ALLOW)
    return rows.join(judged, "address", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"),
        F.when(F.col("verdict").isNull(), 1 / (1 + F.exp(-F.col("odds")))).alias("rejection"))
