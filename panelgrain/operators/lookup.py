"""Joins (JN-*). Joins are not hinted, but for the filed codes of `inner_pairs`: Catalyst and AQE broadcast a side
only when its size allows it, fall back to a sort-merge join otherwise, and split hot keys at run time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def star(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left join of a fact with dimensions that are unique on their keys; facts are never dropped."""
    return reduce(lambda f, d: f.join(d[0], list(d[1]), "left"), dimensions, fact)


@dataclass(frozen=True)
class Layer:
    """One level of a layered lookup: rows of `frame` apply where all `keys` match."""

    frame: DataFrame
    keys: tuple[str, ...]


def layered(df: DataFrame, layers: Sequence[Layer], value: str, name: str | None = None) -> DataFrame:
    """Value of the first layer that knows the row: contract, then country, then default.

    A layer's key must be unique; repeated keys are reduced to one value so rows cannot multiply
    (`layer_conflicts` reports them).
    """
    out, found = df, []
    for i, layer in enumerate(layers):
        single = layer.frame.groupBy(*layer.keys).agg(F.min(value).alias(f"_layer{i}"))
        out = out.join(single, list(layer.keys), "left")
        found.append(F.col(f"_layer{i}"))
    return out.withColumn(name or value, F.coalesce(*found)).drop(*[f"_layer{i}" for i in range(len(layers))])


def layer_conflicts(layer: Layer, value: str) -> DataFrame:
    """Keys of a layer that carry more than one value."""
    spread = layer.frame.groupBy(*layer.keys).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
    return spread.where(F.col("lowest") != F.col("highest"))


# What a LIKE pattern says literally between its wildcards; a backslash makes the next character literal.
LITERAL = r"((?:[^%_\\]|\\.)+)"
# Longest piece of a pattern that codes are filed under, and the number of marks that say which keys are looked for.
GRAM, MARKS = 8, 1 << 18


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def _grams(text: Column, q: Column) -> Column:
    """The distinct substrings of q characters."""
    places = F.when(F.length(text) >= q, F.sequence(F.lit(1), F.length(text) - q + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, q)))


def _looked_for(wanted: DataFrame, keys: Sequence[str]) -> Column:
    """True for rows whose keys may be among the wanted ones, false for most others, before any shuffle.

    A scalar of MARKS booleans, one for each hash: its size does not depend on the keys.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(MARKS))
    there = wanted.select(place.alias("id")).distinct().withColumn("there", F.lit(True))
    every = wanted.sparkSession.range(MARKS).join(there, "id", "left").select("id", F.coalesce("there", F.lit(False)).alias("there"))
    marks = F.transform(F.array_sort(F.collect_list(F.struct("id", "there"))), lambda m: m["there"])
    return F.get(every.agg(marks.alias("marks")).scalar(), place.cast("int"))


def _lengths(rows: DataFrame, size: Column) -> list:
    """The distinct values of a length, so few that they are a constant."""
    return [r["_size"] for r in rows.select(size.alias("_size")).distinct().collect()]


def inner_pairs(codes: DataFrame, rules: DataFrame, on: Sequence[str], code: str, pattern: str) -> DataFrame:
    """Pairs of a code and a rule that share a piece of the pattern's literals, not yet matched.

    An inverted index: a pattern is looked up once, under its longest literal; of several, or of the pieces of
    GRAM characters of a longer one, under the one that fewest codes of its `on` columns have. Codes are filed under their substrings of
    the lengths that patterns have, and only under those that patterns ask for. A pattern with a piece that no code has
    pairs with none under it. The filed codes are many more than their table lets Spark guess, so they are never broadcast.
    """
    literals = F.transform(F.regexp_extract_all(pattern, F.lit(LITERAL), F.lit(1)), _unescaped)
    longest = F.array_max(F.transform(literals, F.length))
    held = rules.withColumn("_q", F.least(F.lit(GRAM), longest)).where("_q > 0")
    every = F.flatten(F.transform(literals, lambda text: _grams(text, F.col("_q"))))
    held = held.select(*on, pattern, "_q", F.array_distinct(every).alias("_grams")).distinct()
    if on:
        sized = codes.join(held.groupBy(*on).agg(F.collect_set("_q").alias("_qs")), list(on))
    else:
        few = _lengths(held, F.col("_q"))
        sized = codes.withColumn("_qs", F.array(*[F.lit(q) for q in few]) if few else F.array().cast("array<int>"))
    pieces = sized.select(*codes.columns, F.explode(F.flatten(F.transform("_qs", lambda q: _grams(F.col(code), q)))).alias("_gram"))
    keys = [*on, "_gram"]
    single = held.where(F.size("_grams") == 1).select(*on, pattern, F.col("_grams")[0].alias("_gram"))
    several = held.where(F.size("_grams") > 1).select(*on, pattern, F.explode("_grams").alias("_gram"))
    counts = pieces.where(_looked_for(several, keys)).groupBy(*keys).agg(F.count("*").alias("_codes"))
    rarest = several.join(counts, keys).groupBy(*on, pattern).agg(F.min_by("_gram", F.struct("_codes", "_gram")).alias("_gram"))
    filed = pieces.where(_looked_for(single.unionByName(several), keys))
    return filed.hint("merge").join(rules.join(single.unionByName(rarest), [*on, pattern]), keys).drop("_gram")


def like_hits(codes: DataFrame, rules: DataFrame, on: Sequence[str], code: str, pattern: str) -> DataFrame:
    """All pairs of a code and a rule with equal `on` columns whose LIKE pattern the code matches.

    What a pattern says literally before its first wildcard is an equi-join key against the prefixes of a
    code; a pattern that begins with a wildcard is joined by its literal end against the suffixes; one with
    wildcards at both ends by the longest literal between them (`inner_pairs`). Only a pattern of
    nothing but wildcards meets every code of its `on` columns. A code makes one row for each length
    that patterns of its `on` columns have, of which those that no pattern may ask for go at once (`_looked_for`).
    A backslash before a wildcard makes it literal, as in LIKE.
    Adds `_prefix` (literal) and `_wild`; other columns of `rules` come along.
    """
    plain = r"(?:[^%_\\]|\\.)*"
    raw = F.regexp_extract(pattern, f"^{plain}", 0)
    prefix, suffix = _unescaped(raw), _unescaped(F.regexp_extract(pattern, f"{plain}$", 0))
    by_end = (prefix == "") & (suffix != "")
    inner = (prefix == "") & (suffix == "") & F.rlike(pattern, F.lit(LITERAL))
    labelled = rules.withColumns({"_prefix": prefix, "_wild": F.length(raw) < F.length(pattern), "_inner": inner})
    # A text between two wildcards only has to be found; Spark compiles other patterns anew for each pair.
    between = F.rlike(pattern, F.lit(r"^%[^%_\\]+%$"))
    matches = F.when(between, F.contains(F.col(code), F.translate(pattern, "%", ""))).otherwise(F.expr(f"`{code}` LIKE `{pattern}`"))
    within = inner_pairs(codes, labelled.where("_inner").drop("_inner"), on, code, pattern).where(matches)
    keyed = labelled.where("NOT _inner").drop("_inner").withColumns({"_end": by_end, "_key": F.when(by_end, suffix).otherwise(prefix)})
    size = F.struct(F.col("_end").alias("end"), F.length("_key").alias("n"))
    if on:
        sized = codes.join(keyed.groupBy(*on).agg(F.collect_set(size).alias("_sizes")), list(on))
    else:
        few = [F.struct(F.lit(s["end"]).alias("end"), F.lit(s["n"]).alias("n")) for s in _lengths(keyed, size)]
        sized = codes.withColumn("_sizes", F.array(*few) if few else F.array().cast("array<struct<end: boolean, n: int>>"))
    probes = sized.withColumn("_size", F.explode("_sizes")).where(F.col("_size.n") <= F.length(code))
    part = F.when(F.col("_size.end"), F.expr(f"right(`{code}`, _size.n)")).otherwise(F.expr(f"left(`{code}`, _size.n)"))
    probes = probes.select(*codes.columns, F.col("_size.end").alias("_end"), part.alias("_key"))
    ends = [*on, "_end", "_key"]
    outer = probes.where(_looked_for(keyed, ends)).join(keyed, ends).where(matches).drop("_end", "_key")
    return outer.unionByName(within)


def _ranked_hits(df: DataFrame, patterns: DataFrame, on: Sequence[str], code: str, pattern: str, values: Sequence[str]) -> tuple[DataFrame, Column]:
    rules = patterns.select(*on, F.col(pattern).alias("_pattern"), *values)
    hits = like_hits(df.select(*on, code).where(F.col(code).isNotNull()).distinct(), rules, on, code, "_pattern")
    rank = F.struct((-F.length("_prefix")).alias("a"), F.col("_wild").alias("b"), F.col("_pattern").alias("c"), F.struct(*values).alias("d") if values else F.lit(0).alias("d"))
    return hits, rank


def like_lookup(
    df: DataFrame, patterns: DataFrame, on: Sequence[str], code: str, pattern: str, values: Sequence[str]
) -> DataFrame:
    """Left lookup of `code` in LIKE patterns that share the `on` keys; see `like_hits`.

    Only distinct codes are matched. Among several matching patterns the longest literal prefix wins,
    then the pattern without wildcards, then the smallest text and values; `like_conflicts` has the others.
    """
    hits, rank = _ranked_hits(df, patterns, on, code, pattern, values)
    best = hits.groupBy(*on, code).agg(F.min_by(F.struct("_pattern", *values), rank).alias("_best"))
    picked = best.select(*on, code, F.col("_best._pattern").alias(pattern), *[F.col(f"_best.{v}").alias(v) for v in values])
    return df.join(picked, [*on, code], "left")


def like_conflicts(
    df: DataFrame, patterns: DataFrame, on: Sequence[str], code: str, pattern: str, values: Sequence[str]
) -> DataFrame:
    """The matching patterns that `like_lookup` passes over, with their values: one row for each (code, pattern)."""
    hits, rank = _ranked_hits(df, patterns, on, code, pattern, values)
    order = Window.partitionBy(*on, code).orderBy(rank)
    lost = hits.withColumn("_place", F.row_number().over(order)).where("_place > 1")
    return lost.select(*on, code, F.col("_pattern").alias(pattern), *values)


def match_any_key(df: DataFrame, dim: DataFrame, pairs: Sequence[tuple[str, str]], extra: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows matched by any of several keys, as one equi-join per key and a distinct union (no OR join)."""
    found = []
    for i, (left, right) in enumerate(pairs):
        side = dim.select(F.col(right).alias(f"_key{i}"), *[F.col(e).alias(f"_x_{e}") for e in extra], *keep)
        on = [F.col(left) == F.col(f"_key{i}"), *[F.col(e) == F.col(f"_x_{e}") for e in extra]]
        found.append(df.join(side, on).drop(f"_key{i}", *[f"_x_{e}" for e in extra]))
    return reduce(DataFrame.unionByName, found).distinct()


def with_parent(df: DataFrame, path: str, parent_path: Column, carry: Sequence[str]) -> DataFrame:
    """Self-join to the parent row on its path; rows without a stored parent get nulls."""
    parents = df.select(F.col(path).alias("_parent"), *[F.col(c).alias(f"parent_{c}") for c in carry])
    return df.withColumn("_parent", parent_path).join(parents, "_parent", "left").withColumnRenamed("_parent", "parent_path")


def not_logged(df: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose run (and key) is not in the log yet."""
    return df.join(log.select(*keys).distinct(), list(keys), "left_anti")


def delivered_status(
    current: DataFrame, previous: DataFrame, keys: Sequence[str], words: tuple[str, str, str] = ("new", "missing", "delivered")
) -> DataFrame:
    """Full outer of two key lists with a status per key."""
    now = current.select(*keys).distinct().withColumn("_now", F.lit(True))
    before = previous.select(*keys).distinct().withColumn("_before", F.lit(True))
    status = F.when(F.col("_before").isNull(), words[0]).when(F.col("_now").isNull(), words[1]).otherwise(words[2])
    return now.join(before, list(keys), "full").withColumn("status", status).drop("_now", "_before")


def newest_change(adds: DataFrame, removes: DataFrame, keys: Sequence[str], added: str, removed: str, name: str) -> DataFrame:
    """Newest add or remove time per key. The two feeds are unioned, so one aggregation replaces an
    outer join and a second grouping."""
    feed = adds.select(*keys, F.col(added).alias(name)).unionByName(removes.select(*keys, F.col(removed).alias(name)))
    return feed.groupBy(*keys).agg(F.max(name).alias(name))


def earlier_claims(claims: DataFrame, key: str = "claim_key", run: str = "run_id", at: str = "claimed_at") -> DataFrame:
    """Claims of a key that another run holds since an earlier moment, with the holder's run.

    The first claim per key is aggregated instead of pairing all claims of a key.
    """
    first = claims.groupBy(key).agg(F.min(F.struct(F.col(at).alias("at"), F.col(run).alias("run"))).alias("_first"))
    joined = claims.join(first, key).where((F.col("_first.run") != F.col(run)) & (F.col("_first.at") <= F.col(at)))
    return joined.withColumn("holder", F.col("_first.run")).drop("_first")


def visible_rows(df: DataFrame, permissions: DataFrame, principal: str, key: str = "security_key") -> DataFrame:
    """Rows whose security key the principal may read."""
    allowed = permissions.where(F.col("principal") == principal).select(key).distinct()
    return df.join(allowed, key, "left_semi")


def fan_out_levels(products: DataFrame, metadata: DataFrame, on: Sequence[str], max_level: int = 9) -> DataFrame:
    """Level names 1..n of a product's structure, plus the name of its own level, however deep, with one join.

    The metadata becomes one map from level to name first instead of being joined once per level.
    """
    named = metadata.where("level IS NOT NULL AND attribute_name IS NOT NULL").groupBy(*on, F.col("level").cast("int").alias("level")).agg(F.max("attribute_name").alias("attribute_name"))
    wide = named.groupBy(*on).agg(F.map_from_entries(F.collect_list(F.struct("level", "attribute_name"))).alias("_names"))
    names = {f"level_name_{i}": F.try_element_at("_names", F.lit(i)) for i in range(1, max_level + 1)}
    joined = products.join(wide, list(on), "left")
    return joined.withColumns({**names, "own_level_name": F.try_element_at("_names", F.col("level").cast("int"))}).drop("_names")


def complete_levels(df: DataFrame, level: str, max_level: int = 9) -> DataFrame:
    """Every level 1..n, with the rows that sit on it or nulls; rows on other levels stay as well."""
    levels = df.sparkSession.range(1, max_level + 1).select(F.col("id").cast("int").alias(level))
    return df.withColumn(level, F.col(level).cast("int")).join(levels, level, "full")
