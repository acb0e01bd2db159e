"""Location name -> country code, as joins against a reference country table.

Runs on the *distinct* locations only (a few hundred names, however large
the data), in stages of decreasing certainty: a fixed rename table, exact
name, common name, then fuzzy.  The fuzzy stage finds every pair that is similar enough
without comparing all pairs: within ``d`` edits, one of ``d + 1``
segments of a name stands whole in the other, at most ``d`` places off.  So segments are
joined with substrings on (length of the name, place, text), an equi-join, and
only those candidate pairs are scored by edit distance.  The best candidate per location wins
(highest similarity, then smallest name); below ``cutoff`` the code stays
null, and the unmatched names are visible in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Awkward location names and the official names they stand for.
NAME_FIXES = {
    "Bonaire Sint Eustatius and Saba": "Bonaire, Sint Eustatius and Saba",
    "Cape Verde": "Cabo Verde",
    "Democratic Republic of Congo": "Congo, The Democratic Republic of",
    "Faeroe Islands": "Faroe Islands",
    "Iran": "Iran, Islamic Republic of",
    "Laos": "Lao People's Democratic Republic",
    "Micronesia (country)": "Micronesia, Federated States of",
    "United States Virgin Islands": "Virgin Islands, U.S.",
}


def similar_names(names: DataFrame, candidates: DataFrame, cutoff: float) -> DataFrame:
    """``(name, cand, sim)`` of all pairs with ``1 - edits / length of the longer one >= cutoff``, in lower case.

    ``names(name)`` and ``candidates(cand)`` hold distinct values; empty names have no similar ones.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("the cut-off must be above 0 and at most 1")
    lengths = F.sequence(F.ceil(F.col("n") * cutoff - 1e-9), F.floor(F.col("n") / cutoff + 1e-9))
    asked = names.where(F.length("name") > 0).select("name", F.lower("name").alias("s")).withColumn("n", F.length("s")) \
        .withColumn("size", F.explode(lengths)) \
        .withColumn("d", F.floor(F.greatest("n", "size") * (1 - cutoff) + 1e-9).cast("int")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("d")))) \
        .withColumn("at", F.floor(F.col("j") * F.col("n") / (F.col("d") + 1)).cast("int")) \
        .withColumn("to", F.floor((F.col("j") + 1) * F.col("n") / (F.col("d") + 1)).cast("int")) \
        .withColumn("part", F.substr("s", F.col("at") + 1, F.col("to") - F.col("at"))) \
        .withColumn("place", F.explode(F.sequence(F.greatest(F.col("at") - F.col("d"), F.lit(0)), F.col("at") + F.col("d")))) \
        .select("name", "size", "place", "part")
    longest = F.lit(int(1 / (1 - cutoff)) + 2 if cutoff < 1 else 1 << 30)  # of a segment: a name has d + 1 of them
    held = candidates.where(F.length("cand") > 0).select("cand", F.lower("cand").alias("s")).withColumn("size", F.length("s").cast("long")) \
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.length("s")))) \
        .withColumn("l", F.explode(F.sequence(F.lit(0), F.least(F.length("s") - F.col("place"), longest)))) \
        .select("cand", "size", "place", F.substr("s", F.col("place") + 1, F.col("l")).alias("part"))
    pairs = asked.join(held, ["size", "place", "part"]).select("name", "cand").distinct()
    a, b = F.lower("name"), F.lower("cand")
    sim = F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
    return pairs.withColumn("sim", sim).where(F.col("sim") >= cutoff)


def country_codes(locations: DataFrame, reference: DataFrame, cutoff: float = 0.6,
                  fixes: dict[str, str] | None = None) -> DataFrame:
    """``(location, code, match_kind)`` for every distinct ``locations.location``.

    ``reference`` has ``(name, common_name, code)``; ``common_name`` may be null.
    """
    fixes = NAME_FIXES if fixes is None else fixes
    mapping = F.create_map(*[F.lit(x) for kv in fixes.items() for x in kv]) if fixes else None
    locs = locations.select("location").where(F.col("location").isNotNull()).distinct()
    locs = locs.withColumn("lookup", F.coalesce(mapping[F.col("location")], F.col("location"))
                           if mapping is not None else F.col("location"))

    ref = reference.select("name", "common_name", "code")
    exact = locs.join(ref.select(F.col("name").alias("lookup"), F.col("code").alias("exact_code")), "lookup", "left")
    common = exact.join(
        ref.where(F.col("common_name").isNotNull())
        .select(F.col("common_name").alias("lookup"), F.col("code").alias("common_code")),
        "lookup", "left")

    todo = common.where(F.col("exact_code").isNull() & F.col("common_code").isNull()).select("location", "lookup")
    found = similar_names(todo.select(F.col("lookup").alias("name")).distinct(), ref.select(F.col("name").alias("cand")).distinct(), cutoff)
    codes = ref.select(F.col("name").alias("cand"), F.col("code").alias("cand_code"))
    scored = todo.join(found, F.col("lookup") == F.col("name")).join(codes, "cand")
    w = Window.partitionBy("location").orderBy(F.col("sim").desc(), F.col("cand"))
    best = scored.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(
        "location", F.col("cand_code").alias("fuzzy_code"))
    out = common.join(best, "location", "left")
    code = F.coalesce("exact_code", "common_code", "fuzzy_code")
    kind = (F.when(F.col("exact_code").isNotNull(), "exact")
            .when(F.col("common_code").isNotNull(), "common")
            .when(F.col("fuzzy_code").isNotNull(), "fuzzy"))
    return out.select("location", code.alias("code"), kind.alias("match_kind"))
