"""All name pairs whose token-set score exceeds a threshold, without comparing all names.

A pair can pass for two reasons, and each has its own complete filter.

1. Nearly all of one name is shared. The rest of that name then weighs less than a known
   share of it, so among its rarest tokens up to that weight one must be shared. Names
   meet on such a token; common tokens stay out unless a name has nothing rarer.
2. The two rests are alike letter by letter. The score and the lengths bound the letters
   each side may drop, in one of two ways.

   Where neither side may drop more than one, or short names two together, names meet on
   what is left of their tokens: all tokens, or all with one or two letters dropped, or
   tokens joined where a dropped letter is the space between them. Each key says how many
   letters either side has dropped, as their lengths allow. This finds little but the pairs
   themselves.

   Else a dropped letter destroys at most two letter pairs of its name, an inserted one at
   most one, so of e destroyable pairs all others are common. With one order of all letter
   pairs, rarest first, two names that have at least three pairs in common have three of
   them among the first e + 3 of each side. Names meet on three of those at once, and only
   what then has enough letter pairs in common is scored.

Both sides hold distinct token keys, so copies of a name count once. No candidate list is
capped, and every distinct candidate is scored exactly, once.

Tables that grow with the names are joined by shuffles (hint `merge`): as files they are so
small that Spark would broadcast them, and as rows many times larger, all in the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.similarity import token_set_score
from starledger.sources.shared import materialize

# Letter pairs that two names must meet on at once.
MEETING = 3
#: Letters of two names together up to which they meet on what two dropped letters leave.
SHORT = 40


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """Shuffle to the configured number of tasks.

    Small rows that cost much CPU each would otherwise be coalesced by size into few.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *by)


def _tokens(name: Column) -> Column:
    return F.split(name, " ")


def _weight(tokens: Column) -> Column:
    """Letters of the tokens plus one separator each."""
    return F.aggregate(tokens, F.lit(0), lambda total, t: total + F.length(t) + 1)


def _rarest_first(names: DataFrame, parts: Column, counts: DataFrame) -> DataFrame:
    """Parts of each name as an array, rarest over both sides first."""
    exploded = names.select("name", F.explode(parts).alias("part"))
    return (
        exploded.join(counts.hint("merge"), "part")
        .groupBy("name")
        .agg(F.sort_array(F.collect_list(F.struct("n", "part"))).alias("_ranked"))
        .select("name", F.col("_ranked.part").alias("parts"))
    )


def _part_counts(left: DataFrame, right: DataFrame, parts: Column) -> DataFrame:
    both = left.select("name").unionAll(right.select("name"))
    exploded = both.select(F.explode(parts).alias("part"))
    return exploded.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def _mostly_shared(left: DataFrame, right: DataFrame, counts: DataFrame, threshold: float):
    """Pairs where the rest of a `left` name is small next to what it shares with `right`."""
    tokens = _tokens(F.col("name"))
    slack = 2 * (1 - threshold) / (2 - threshold)

    def prefix(parts: Column, limit: Column) -> Column:
        # Tokens up to and including the one that reaches the limit.
        before = F.transform(
            parts, lambda _, i: _weight(F.slice(parts, F.lit(1), i)).cast("double")
        )
        kept = F.filter(F.arrays_zip(parts.alias("t"), before.alias("w")), lambda z: z["w"] < limit)
        return F.transform(kept, lambda z: z["t"])

    ranked = _rarest_first(left, tokens, counts)
    limit = F.greatest(F.length("name") * slack, F.lit(1.0))
    probes = ranked.select(
        F.col("name").alias("l"), F.explode(prefix(F.col("parts"), limit)).alias("part")
    )
    entries = right.select(F.col("name").alias("r"), F.explode(tokens).alias("part"))
    mine, other = _tokens(F.col("l")), _tokens(F.col("r"))
    rest = _weight(F.array_except(mine, other))
    shared = _weight(F.array_intersect(mine, other)) - 1
    near = (rest == 0) | (rest * threshold < 2 * (1 - threshold) * shared + 1e-9)
    return probes.join(entries.hint("merge"), "part").where(near).select("l", "r")


def _drops(n: int, m: int, threshold: float) -> tuple[int, int] | None:
    """Most letters that names of `n` and `m` letters may drop, None if no pair can pass."""
    # own + other drops stay below this number, and own - other is n - m.
    edits = math.ceil((1 - threshold) * (n + m) - 1e-9) - 1
    own = min((edits + n - m) // 2, n)
    other = own - (n - m)
    return (own, other) if own >= 0 and other >= 0 else None


def _few_drops(n, m, own, other):
    """Whether names of `n` and `m` letters that drop so many meet on what is left of them."""
    return ((own <= 1) & (other <= 1)) | ((own + other <= 2) & (n + m <= SHORT))


def _most_destroyed(n: int, others: Iterable[int], threshold: float) -> int | None:
    """Most letter pairs that edits may destroy in a name of length `n`.

    None if no pair of these lengths needs to meet on letter pairs.
    """
    drops = [(m, _drops(n, m, threshold)) for m in others]
    return max((2 * d[0] + d[1] for m, d in drops if d and not _few_drops(n, m, *d)), default=None)


def _roles(own: Iterable[int], others: Iterable[int], threshold: float) -> dict[tuple[int, int], list[int]]:
    """Lengths by how many letters a name of that length and its partner drop."""
    found: dict[tuple[int, int], list[int]] = {}
    for n in own:
        for m in others:
            drops = _drops(n, m, threshold)
            if drops and _few_drops(n, m, *drops):
                for fewer in range(min(drops) + 1):
                    found.setdefault((drops[0] - fewer, drops[1] - fewer), []).append(n)
    return found


def _lengths(names: DataFrame) -> list[int]:
    """Distinct name lengths: a handful of integers, whatever the number of names."""
    return [r[0] for r in names.select(F.length("name")).distinct().collect()]


def _by_length(values: dict[int, int]) -> Column:
    """Look up a per-length number for column `name`; null where there is none."""
    entries = [F.lit(x) for pair in sorted(values.items()) for x in pair]
    if not entries:
        return F.lit(None).cast("int")
    return F.try_element_at(F.create_map(*entries), F.length("name"))


def _letter_pairs(name: Column) -> Column:
    """Letter pairs of each token with its two edges, repeats numbered apart."""
    padded = F.transform(_tokens(name), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))
    pairs = F.flatten(
        F.transform(
            padded,
            lambda t: F.transform(
                F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2))
            ),
        )
    )
    ordered = F.array_sort(pairs)
    return F.transform(
        ordered,
        lambda p, i: F.concat(p, (i - F.array_position(ordered, p)).cast("string")),
    )


def _meeting_keys(prefix: Column, size: int) -> Column:
    """Hashes of all choices of `size` parts of an array, in its order."""
    if size == 1:
        return F.transform(prefix, lambda part: F.xxhash64(part))

    def following(part: Column, i: Column) -> Column:
        rest = F.slice(prefix, i + 2, F.size(prefix))
        return F.transform(_meeting_keys(rest, size - 1), lambda key: F.xxhash64(part, key))

    return F.flatten(F.transform(prefix, following))


def _one_less(tokens: Column) -> Column:
    """Lists of tokens with one letter dropped, or two of them joined, each in its place."""

    def letter_dropped(token: Column, i: Column) -> Column:
        before, after = F.slice(tokens, F.lit(1), i), F.slice(tokens, i + 2, F.size(tokens))
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(token), F.lit(1))),
            lambda at: F.concat(
                before,
                F.array(F.concat(F.substring(token, F.lit(1), at - 1), F.substring(token, at + 1, F.length(token)))),
                after,
            ),
        )

    def joined(token: Column, i: Column) -> Column:
        # Tokens stand in order, and so do those of a rest.
        before, later = F.slice(tokens, F.lit(1), i), F.slice(tokens, i + 2, F.size(tokens))
        return F.transform(
            later,
            lambda other, j: F.concat(
                before, F.array(F.concat(token, other)), F.slice(later, F.lit(1), j),
                F.slice(later, j + 2, F.size(later)),
            ),
        )

    return F.concat(F.flatten(F.transform(tokens, letter_dropped)), F.flatten(F.transform(tokens, joined)))


def _remainders(name: Column, dropped: int) -> Column:
    """What may be left of a name's tokens when so many letters are dropped, tokens in order."""
    rests = F.array(_tokens(name))
    for _ in range(dropped):
        rests = F.flatten(F.transform(rests, _one_less))
    return F.array_distinct(F.transform(rests, lambda rest: F.array_join(F.sort_array(rest), " ")))


def _nearly_equal(left: DataFrame, right: DataFrame, lengths, threshold: float) -> DataFrame:
    """Pairs that are equal once both sides have dropped the few letters they may drop."""

    def keyed(side: DataFrame, own: list[int], other: list[int], out: str) -> DataFrame:
        roles = _roles(own, other, threshold)
        rows = _spread(side.where(F.length("name").isin(sorted({n for some in roles.values() for n in some}))), "name")
        keys = []
        for mine, theirs in sorted(roles):
            # Both sides hash the left side's letters first.
            role = [F.lit(n) for n in ((mine, theirs) if out == "l" else (theirs, mine))]
            rests = F.transform(_remainders(F.col("name"), mine), lambda rest: F.xxhash64(rest, *role))
            keys.append(F.when(F.length("name").isin(sorted({*roles[mine, theirs]})), rests))
        listed = F.flatten(F.array_compact(F.array(*keys))) if keys else F.array().cast("array<bigint>")
        return rows.select(F.col("name").alias(out), F.explode(listed).alias("_key"))

    close = F.abs(F.length("l") - F.length("r")) < (1 - threshold) * (F.length("l") + F.length("r"))
    met = keyed(left, *lengths, "l").join(keyed(right, *lengths[::-1], "r").hint("merge"), "_key")
    return met.where(close).select("l", "r")


def _ranked_pairs(names: DataFrame) -> DataFrame:
    """Hashes of each name's letter pairs, rarest first, as a written table."""
    exploded = _spread(names, "name").select("name", F.explode(_letter_pairs(F.col("name"))).alias("part"))
    exploded = materialize(exploded.select("name", F.xxhash64("part").alias("part")), "letter-pairs")
    counts = exploded.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    ranked = exploded.join(counts, "part").groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct("n", "part"))).alias("_ranked")
    )
    return materialize(ranked.select("name", F.col("_ranked.part").alias("parts")), "ranked-pairs")


def _alike(left: DataFrame, right: DataFrame, lengths, threshold: float) -> DataFrame:
    """Pairs that have so many letter pairs in common that the score may pass.

    Of lengths at which the sides may drop more letters than `_nearly_equal` looks at.
    """
    if all(_most_destroyed(n, lengths[1], threshold) is None for n in lengths[0]):
        return left.select(F.col("name").alias("l"), F.col("name").alias("r")).limit(0)
    ranked = _ranked_pairs(left.select("name").union(right.select("name")).distinct())

    def keyed(side: DataFrame, own: list[int], other: list[int], out: str) -> DataFrame:
        sizes = {n: _most_destroyed(n, other, threshold) for n in own}
        sizes = {n: e for n, e in sizes.items() if e is not None}
        rows = ranked.join(side.hint("merge"), "name", "left_semi").withColumn("_e", _by_length(sizes))
        rows = _spread(rows.where("_e is not null"), "name")
        # A name that keeps fewer than MEETING pairs for sure also meets on single ones.
        keys = [
            F.when(
                F.lit(size == MEETING) | (F.size("parts") - F.col("_e") < MEETING),
                _meeting_keys(F.slice("parts", F.lit(1), F.col("_e") + size), size),
            )
            for size in range(1, MEETING + 1)
        ]
        listed = F.flatten(F.array_compact(F.array(*keys)))
        return rows.select(F.col("name").alias(out), F.explode(listed).alias("_key"))

    n, m = F.length("l"), F.length("r")
    close = F.abs(n - m) < (1 - threshold) * (n + m)
    # What this very pair of lengths may drop; where that is little, other keys find the pair.
    edits = F.ceil((n + m) * (1 - threshold) - 1e-9) - 1
    own = F.floor((edits + n - m) / 2)
    many = ~_few_drops(n, m, F.least(own, n), F.least(own, n) - (n - m))
    met = keyed(left, *lengths, "l").join(keyed(right, *lengths[::-1], "r").hint("merge"), "_key")
    pairs = met.where(close & many).select("l", "r").distinct()
    for out in "lr":
        own_parts = ranked.select(F.col("name").alias(out), F.col("parts").alias(f"{out}_parts"))
        pairs = pairs.join(own_parts.hint("merge"), out)
    # What these edits may destroy on the left side.
    common = F.size(F.array_intersect("l_parts", "r_parts"))
    return pairs.where(common >= F.size("l_parts") - (3 * own - (n - m))).select("l", "r")


def similar_names(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All (l, r, score) with score above `threshold`.

    Both frames have one column `name` of distinct, non-empty token keys. They are read
    several times, so pass written tables.
    """
    lengths = (_lengths(left), _lengths(right))
    tokens = _tokens(F.col("name"))
    counts = _part_counts(left, right, tokens)
    swapped = _mostly_shared(right, left, counts, threshold)
    pairs = [
        _mostly_shared(left, right, counts, threshold),
        swapped.select(F.col("r").alias("l"), F.col("l").alias("r")),
        _nearly_equal(left, right, lengths, threshold),
        _alike(left, right, lengths, threshold),
    ]
    found = _spread(reduce(DataFrame.unionAll, pairs), "l", "r").distinct()
    # Distinct pairs first: Spark would push a filter on a plain function's score below all
    # of this, and score each pair as often as it met, near or not.
    scored = found.withColumn("score", token_set_score("l", "r", once=True))
    return scored.where(F.col("score") > threshold)


def mutual_best(pairs: DataFrame) -> DataFrame:
    """Pairs in which each name is the other's best: highest score, then smallest pair hash.

    The best partner is an aggregate, so no list of partners is ever gathered. Ties go by
    a hash because names in order would wait for each other in long chains.
    """
    order = (-F.col("score"), F.md5(F.concat_ws("|", "l", "r").cast("binary")))
    best_r = pairs.groupBy("l").agg(F.min(F.struct(*order, "r")).alias("_b"))
    best_l = pairs.groupBy("r").agg(F.min(F.struct(*order, "l")).alias("_b"))
    return best_r.select("l", F.col("_b.r").alias("r"), (-F.col("_b.col1")).alias("score")).join(
        best_l.select(F.col("_b.l").alias("l"), "r").hint("merge"), ["l", "r"]
    )


def accepted_pairs(pairs: DataFrame) -> DataFrame:
    """One-to-one pairs of names, accepted in rounds until no pair has two free names.

    Every round accepts the mutually best pairs and drops the other pairs of their names.
    The best pair of all that remain is always mutual, so each round makes progress; the
    remaining pairs and the accepted ones are written tables.
    """
    free = materialize(pairs, "similar-names")
    found = []
    while not free.isEmpty():
        accepted = materialize(mutual_best(free), "accepted-names")
        found.append(accepted)
        for name in "lr":
            free = free.join(accepted.select(name).hint("merge"), name, "left_anti")
        free = materialize(free.select("l", "r", "score"), "similar-names")
    return reduce(DataFrame.unionAll, found) if found else pairs.limit(0)


def best_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """One-to-one pairs of names with score above `threshold`, best pairs first.

    The pairs of the upper half of the scores are accepted before others are looked for, and
    then only between names that are still free. The order of acceptance begins with the
    score, so the result is that of `accepted_pairs` over all pairs, most of which are never
    built: a name has far more distant relatives than near ones.
    """
    found = []
    for low in ((1 + threshold) / 2, threshold):
        for part in found:
            left, right = (
                materialize(side.join(part.select(F.col(c).alias("name")).hint("merge"), "name", "left_anti"), "names")
                for side, c in ((left, "l"), (right, "r"))
            )
        found.append(accepted_pairs(similar_names(left, right, low)))
    return reduce(DataFrame.unionAll, found)
