"""Probabilistic record linkage within blocks, without forming the pairs of a block.

The model is that of Fellegi & Sunter (1969): every compared column has a
probability m of agreeing on a true match and u on a random pair. A pair's
comparison pattern says per column whether both values agree (1), differ (0) or
whether one is missing (-1, which carries no weight).

A block may hold a third of all records, so its pairs cannot be listed. All the
model needs is how many pairs show each pattern, and group sizes tell that exactly:
records that share the values of some columns form C(n, 2) pairs agreeing at least on
these columns, and inclusion-exclusion over the sets of columns turns "at least" into
"exactly". Cost is one row per distinct record and set of columns that the asked-for
patterns need: at most 2^k - 1 for k compared columns.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations_with_replacement, product
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.components import connected_components
from carelake.schemas import require_columns

# The work per record and the size of the pattern tables grow with this number only.
MAX_COMPARED = 6

AGREE, DIFFER, MISSING = 1, 0, -1

KEY = ("key_0", "key_1")
Pattern = tuple[int, ...]


@dataclass(frozen=True)
class LinkSettings:
    """Record id, the columns that must be equal within a block, and those compared."""

    unique_id: str = "unique_id"
    block: Sequence[str] = ("dob",)
    compare: Sequence[str] = ("first_name", "last_name", "dob", "city")

    def __post_init__(self) -> None:
        if not self.block or not 1 <= len(self.compare) <= MAX_COMPARED:
            raise ValueError(f"linkage: needs a block and 1 to {MAX_COMPARED} compared columns")


@dataclass(frozen=True)
class LinkModel:
    """m and u per compared column, and the share of matches among the blocked pairs."""

    m: Mapping[str, float]
    u: Mapping[str, float]
    prior: float
    history: Sequence[float] = field(default=())

    def weights(self, column: str) -> dict[int, float]:
        m, u = self.m[column], self.u[column]
        return {AGREE: math.log2(m / u), DIFFER: math.log2((1 - m) / (1 - u)), MISSING: 0.0}

    def match_weight(self, columns: Sequence[str], pattern: Pattern) -> float:
        start = math.log2(self.prior / (1 - self.prior))
        return start + sum(self.weights(c)[g] for c, g in zip(columns, pattern))

    def probability(self, columns: Sequence[str], pattern: Pattern) -> float:
        return 1 / (1 + 2.0 ** -self.match_weight(columns, pattern))


def _bits(columns: Sequence[str]) -> list[int]:
    return [1 << i for i in range(len(columns))]


def _mask(pattern: Pattern, states: tuple[int, ...]) -> int:
    return sum(1 << i for i, g in enumerate(pattern) if g in states)


def _patterns(k: int) -> list[Pattern]:
    return list(product((AGREE, DIFFER, MISSING), repeat=k))


def _is_block_column(settings: LinkSettings, column: str) -> bool:
    return column in settings.block


def _check(records: DataFrame, settings: LinkSettings, operator: str) -> None:
    require_columns(records, [settings.unique_id, *settings.block, *settings.compare], operator)


def _blocked(records: DataFrame, settings: LinkSettings) -> DataFrame:
    """Records that have a block; equality with a null block is never true."""
    _check(records, settings, "linkage")
    return records.dropna(subset=list(settings.block))


def _group_pairs(records: DataFrame, settings: LinkSettings, asked: Collection[tuple[int, int]]) -> DataFrame:
    """Pairs that agree at least on a set of columns, per group of equal values.

    One row per block, `agree` (bit set of columns), the values of these columns and
    `filled` (bit set holding `agree`): `n` pairs of records that have all columns of
    `filled` and share the values, for the pairs of sets that are `asked` for. A record is
    copied once for each asked set `agree` that it has filled, but for the set of the block
    columns alone, whose groups are whole blocks and are counted without copies; `filled`
    sets are only formed for groups of more than one record.
    """
    k = len(settings.compare)
    names = [f"c{i}" for i in range(k)]
    blocks = [f"b{i}" for i in range(len(settings.block))]
    copies = (
        _blocked(records, settings)
        .groupBy(
            *[F.col(c).alias(b) for c, b in zip(settings.block, blocks)],
            *[F.col(c).alias(n) for c, n in zip(settings.compare, names)],
        )
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    filled = reduce(add, [F.when(F.col(n).isNotNull(), bit).otherwise(0) for n, bit in zip(names, _bits(names))])
    copies = copies.withColumn("have", filled)
    wanted: dict[int, list[int]] = {}
    for agree, both in sorted(asked):
        wanted.setdefault(agree, []).append(both)
    # A block column always agrees; sets without it are never asked for.
    fixed = sum(bit for c, bit in zip(settings.compare, _bits(names)) if _is_block_column(settings, c))

    def counted(rows: DataFrame, agree: Column) -> DataFrame:
        in_set = [
            F.when(F.col("agree").bitwiseAND(F.lit(bit)) != 0, F.col(n)).alias(n) for n, bit in zip(names, _bits(names))
        ]
        return rows.withColumn("agree", agree).select(*blocks, "agree", *in_set, "have", "copies").groupBy(
            *blocks, "agree", *names, "have").agg(F.sum("copies").alias("members"))

    sides = []
    explode = [s for s in wanted if s != fixed]
    if explode:
        held = F.filter(F.array(*[F.lit(s) for s in explode]), lambda s: s.bitwiseAND(F.col("have")) == s)
        sides.append(counted(copies, F.explode(held)))
    if fixed in wanted:
        sides.append(counted(copies, F.lit(fixed)))
    groups = reduce(DataFrame.unionByName, sides).groupBy(*blocks, "agree", *names).agg(
        F.collect_list(F.struct("have", "members")).alias("held"), F.sum("members").alias("total")  # at most 2^k of them
    ).filter(F.col("total") > 1)
    sets = F.array(*[F.array(*[F.lit(f) for f in wanted.get(s, [-1])]) for s in range(1 << k)])
    having = groups.withColumn("filled", F.explode(F.get(sets, F.col("agree"))))
    members = F.aggregate(
        F.filter("held", lambda h: h["have"].bitwiseAND(F.col("filled")) == F.col("filled")), F.lit(0).cast("bigint"),
        lambda n, h: n + h["members"])
    return having.withColumn("m", members).filter(F.col("m") > 1).select(
        *blocks, "agree", *names, "filled", _pairs_of("m").alias("n"))


def _pairs_of(name: str) -> Column:
    """C(n, 2) as a decimal, since the pairs of a few billion records overflow a long.

    Of two neighbours the even one is halved before they are multiplied.
    """
    n = F.col(name)
    even = n % 2 == 0
    left = F.when(even, F.expr(f"{name} div 2")).otherwise(n)
    right = F.when(even, n - 1).otherwise(F.expr(f"({name} - 1) div 2"))
    return left.cast("decimal(19,0)") * right.cast("decimal(19,0)")


def _signs(patterns: Sequence[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """Inclusion-exclusion: what a row of `_group_pairs` adds to each exact pattern.

    Rows (pattern, exact, agree, filled, sign): at most 5 to the power of the columns, so
    their table may be broadcast.
    """
    rows = []
    for index, pattern in enumerate(patterns):
        agree, both = _mask(pattern, (AGREE,)), _mask(pattern, (AGREE, DIFFER))
        differ, missing = both & ~agree, _mask(pattern, (MISSING,))
        for more_agree in _submasks(differ):
            for more_filled in _submasks(missing):
                sign = -1 if (more_agree.bit_count() + more_filled.bit_count()) % 2 else 1
                rows.append((index, agree, agree | more_agree, both | more_filled, sign))
    return rows


def _submasks(mask: int) -> list[int]:
    out, sub = [], mask
    while True:
        out.append(sub)
        if sub == 0:
            return out
        sub = (sub - 1) & mask


def _exact(
    records: DataFrame, settings: LinkSettings, patterns: Sequence[Pattern], by_block: bool,
    by_values: bool,
) -> DataFrame:
    """Pairs per exact pattern, optionally per block and per values agreed on."""
    k = len(settings.compare)
    names = [f"c{i}" for i in range(k)]
    blocks = [f"b{i}" for i in range(len(settings.block))] if by_block else []
    signs = _signs(patterns)
    groups = _group_pairs(records, settings, {(agree, filled) for _, _, agree, filled, _ in signs})
    if not by_values:
        groups = groups.groupBy(*blocks, "agree", "filled").agg(F.sum("n").alias("n"))
    signed = records.sparkSession.createDataFrame(signs, "pattern int, exact int, agree int, filled int, sign int")
    joined = groups.join(F.broadcast(signed), ["agree", "filled"])
    values = [
        F.when(F.col("exact").bitwiseAND(F.lit(bit)) != 0, F.col(n)).alias(n)
        for n, bit in zip(names, _bits(names))
    ] if by_values else []
    value_names = names if by_values else []
    return (
        joined.select(*blocks, *values, "pattern", (F.col("n") * F.col("sign")).alias("n"))
        .groupBy(*blocks, *value_names, "pattern")
        .agg(F.sum("n").alias("n_pairs"))
        .filter(F.col("n_pairs") > 0)
    )


def _possible(settings: LinkSettings) -> list[Pattern]:
    """All patterns that can occur: block columns always agree."""
    return [
        p for p in _patterns(len(settings.compare))
        if all(g == AGREE for g, c in zip(p, settings.compare) if _is_block_column(settings, c))
    ]


def _gammas(settings: LinkSettings, patterns: Sequence[Pattern]) -> list[Column]:
    codes = F.array(*[F.array(*[F.lit(g) for g in p]) for p in patterns])
    return [
        F.get(F.get(codes, F.col("pattern")), F.lit(i)).alias(f"gamma_{c}")
        for i, c in enumerate(settings.compare)
    ]


def pattern_counts(records: DataFrame, settings: LinkSettings, by_block: bool = False) -> DataFrame:
    """How many candidate pairs show each comparison pattern, in all or per block.

    Candidate pairs are all pairs of different records of one block; the counts are
    exact. Columns: the block columns if asked for, `gamma_<column>`, `n_pairs`.
    """
    patterns = _possible(settings)
    counts = _exact(records, settings, patterns, by_block, by_values=False)
    blocks = [F.col(f"b{i}").alias(c) for i, c in enumerate(settings.block)] if by_block else []
    return counts.select(*blocks, *_gammas(settings, patterns), "n_pairs")


def agreement_rates(
    records: DataFrame, settings: LinkSettings
) -> DataFrame:
    """u of every compared column: the share of all pairs, blocked or not, that agree.

    Pairs with a missing value are left out. Columns: `column_name`, `n_agree`,
    `n_pairs`, `u`. Value counts give the rates over all pairs exactly.
    """
    _check(records, settings, "agreement_rates")
    values = records.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in settings.compare
    ]))).filter(F.col("value").isNotNull())
    # Decimals: the pairs of 100 billion records do not fit in a long.
    n = F.col("n").cast("decimal(19,0)")
    sizes = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = sizes.groupBy("column_name").agg(
        F.sum((n * (n - 1)).cast("decimal(38,0)")).alias("agree"), F.sum(n).alias("total")
    )
    total = F.col("total").cast("decimal(19,0)")
    all_pairs = (total * (total - 1)).cast("decimal(38,0)")
    return sums.select(
        "column_name",
        (F.col("agree") / 2).cast("decimal(38,0)").alias("n_agree"),
        (all_pairs / 2).cast("decimal(38,0)").alias("n_pairs"),
        F.try_divide(F.col("agree").cast("double"), all_pairs.cast("double")).alias("u"),
    )


def estimate(
    records: DataFrame, settings: LinkSettings, fixed_m: Mapping[str, float] | None = None,
    start_m: float = 0.9, prior: float = 0.01, max_iterations: int = 10_000, tolerance: float = 1e-6,
) -> LinkModel:
    """Estimate the model: u from all pairs, then m and the prior by expectation-maximisation.

    EM (Dempster, Laird & Rubin 1977) runs on the pattern counts, at most 3^k rows,
    which is all that reaches the driver. A block column agrees on every candidate
    pair, so nothing can be learnt for it: its m is `fixed_m`'s or `start_m`. EM that
    has not settled to `tolerance` after `max_iterations` rounds is an error.
    """
    fixed = {c: start_m for c in settings.compare if _is_block_column(settings, c)}
    fixed.update(fixed_m or {})
    rates = agreement_rates(records, settings).collect()
    tiny = 1e-12
    u = {c: tiny for c in settings.compare}
    u.update({r["column_name"]: min(max(r["u"] or 0.0, tiny), 1 - tiny) for r in rates})
    gammas = [f"gamma_{c}" for c in settings.compare]
    counted = sorted(
        (tuple(r[g] for g in gammas), int(r["n_pairs"]))
        for r in pattern_counts(records, settings).collect()
    )
    total = sum(n for _, n in counted)
    m = {c: fixed.get(c, start_m) for c in settings.compare}
    if total == 0:
        return LinkModel(m, u, prior)
    free = [(i, c) for i, c in enumerate(settings.compare) if not _is_block_column(settings, c)]

    def odds(pattern: Pattern) -> float:
        value = prior / (1 - prior)
        for i, c in free:
            if pattern[i] == AGREE:
                value *= m[c] / u[c]
            elif pattern[i] == DIFFER:
                value *= (1 - m[c]) / (1 - u[c])
        return value

    history = []
    for _ in range(max_iterations):
        shares = [(p, n * odds(p) / (1 + odds(p))) for p, n in counted]
        matches = sum(s for _, s in shares)
        new_prior = min(max(matches / total, tiny), 1 - tiny)
        new_m = dict(m)
        for i, c in free:
            seen = sum(s for p, s in shares if p[i] != MISSING)
            if c not in fixed and seen > 0:
                agreed = sum(s for p, s in shares if p[i] == AGREE)
                new_m[c] = min(max(agreed / seen, tiny), 1 - tiny)
        change = max(abs(new_prior - prior), *[abs(new_m[c] - m[c]) for c in m])
        prior, m = new_prior, new_m
        history.append(change)
        if change < tolerance:
            break
    else:
        raise ValueError(f"estimate: not settled after {max_iterations} rounds, last change {history[-1:]}")
    return LinkModel(m, u, prior, tuple(history))


def model_frame(records: DataFrame, settings: LinkSettings, model: LinkModel) -> DataFrame:
    """The model as a table: `column_name`, `m`, `u`, `prior`."""
    rows = [(c, float(model.m[c]), float(model.u[c]), float(model.prior)) for c in settings.compare]
    schema = "column_name string, m double, u double, prior double"
    return records.sparkSession.createDataFrame(rows, schema)


def _predicted(settings: LinkSettings, model: LinkModel, threshold: float) -> list[Pattern]:
    return [
        p for p in _possible(settings) if model.probability(settings.compare, p) >= threshold
    ]


def predict(
    records: DataFrame, settings: LinkSettings, model: LinkModel, threshold: float = 0.8
) -> DataFrame:
    """All predicted matches, as scored groups: every pair above the threshold is in one row.

    A row holds the block, the values the pairs of the row agree on (null in the
    other columns), their pattern, weight and probability, and how many pairs of
    records it stands for. There are at most 2^k rows per distinct record, however
    many pairs match. `partners` lists the pairs of given records.
    """
    patterns = _predicted(settings, model, threshold)
    groups = _exact(records, settings, patterns, by_block=True, by_values=True)
    weights = F.array(*[F.lit(model.match_weight(settings.compare, p)) for p in patterns]).cast("array<double>")
    shares = F.array(*[F.lit(model.probability(settings.compare, p)) for p in patterns]).cast("array<double>")
    values = [
        F.col(f"c{i}").alias(c) for i, c in enumerate(settings.compare)
        if not _is_block_column(settings, c)
    ]
    return groups.select(
        *[F.col(f"b{i}").alias(c) for i, c in enumerate(settings.block)],
        *values,
        *_gammas(settings, patterns),
        F.get(weights, F.col("pattern")).alias("match_weight"),
        F.get(shares, F.col("pattern")).alias("match_probability"),
        "n_pairs",
    )


def gamma(left: Column, right: Column) -> Column:
    """Comparison level of two values."""
    return F.when(left.isNull() | right.isNull(), MISSING).when(left == right, AGREE).otherwise(DIFFER)


def partners(
    wanted: DataFrame, records: DataFrame, settings: LinkSettings, model: LinkModel,
    threshold: float = 0.8,
) -> DataFrame:
    """The records that match the `wanted` ones, one scored row per pair.

    The result has a row per partner, so ask for the records of interest. Records meet
    on the keys of `clusters`, which only matching ones share, so no pair is formed
    that is not in the result.
    """
    _check(wanted, settings, "partners")
    types = {c: records.schema[c].dataType for c in (*settings.block, *settings.compare)}
    wanted = wanted.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    both = [_blocked(df, settings) for df in (wanted, records)]
    found = [_link_keys(df, settings, model, threshold, both) for df in both]
    if found[0] is None:
        raise ValueError("partners: no comparison pattern reaches the threshold")
    l, r = (df.alias(side) for df, side in zip(found, ("l", "r")))
    meet = [
        *[F.col(f"l.{key}") == F.col(f"r.{key}") for key in KEY],
        (F.col("l.sides") == 1) | (F.col("l.side") != F.col("r.side")),
        F.col("l.id") != F.col("r.id"),
    ]
    sides = [
        F.col(f"{s}.v{i}").alias(f"{c}_{s}") for i, c in enumerate(settings.compare) for s in ("l", "r")
    ]
    # A pair that meets several requirements shares several keys.
    pairs = l.join(r, meet).select(
        F.col("l.id").alias("unique_id_l"), F.col("r.id").alias("unique_id_r"), *sides
    ).distinct()
    weight = F.lit(math.log2(model.prior / (1 - model.prior)))
    for c in settings.compare:
        level, weights = F.col(f"gamma_{c}"), model.weights(c)
        weight = weight + F.when(level == AGREE, weights[AGREE]).when(level == DIFFER, weights[DIFFER]).otherwise(0.0)
    levels = {f"gamma_{c}": gamma(F.col(f"{c}_l"), F.col(f"{c}_r")) for c in settings.compare}
    chance = F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight")))
    return pairs.withColumns(levels).withColumn("match_weight", weight).withColumn("match_probability", chance)


def clusters(
    records: DataFrame, settings: LinkSettings, model: LinkModel, threshold: float = 0.8
) -> DataFrame:
    """One `cluster_id` per record: the smallest record id among all that predicted
    matches connect it to, directly or over others.

    Records that agree on enough columns all match each other, so they are tied to one
    member of their group instead of pairwise: the number of links grows with the
    records. See `_link_keys` for missing values.
    """
    _check(records, settings, "clusters")
    record_id = settings.unique_id
    blocked = _blocked(records, settings)
    keys = _link_keys(blocked, settings, model, threshold, [blocked])
    links = None
    if keys is not None:
        heads = keys.groupBy(*KEY).agg(
            F.min("id").alias("head"), F.min("side").alias("first"), F.max("side").alias("last"),
            F.max("sides").alias("sides"),
        ).filter((F.col("sides") == 1) | (F.col("first") != F.col("last")))
        links = keys.select(*KEY, "id").join(heads.select(*KEY, "head"), list(KEY)).select(
            F.col("id").alias("left"), F.col("head").alias("right")
        ).filter(F.col("left") != F.col("right")).distinct()
    ids = records.select(F.col(record_id).alias("id"))
    if links is None:
        return ids.select(F.col("id").alias(record_id), F.col("id").alias("cluster_id"))
    found = connected_components(links)
    return ids.join(found, "id", "left").select(
        F.col("id").alias(record_id), F.coalesce("component", "id").alias("cluster_id")
    )


def link_keys(records: DataFrame, settings: LinkSettings, model: LinkModel, threshold: float) -> DataFrame | None:
    """The keys that records hold whatever others there are; see `_link_keys`. None where no pattern reaches the threshold."""
    _check(records, settings, "link_keys")
    return _link_keys(_blocked(records, settings), settings, model, threshold, None)


def _link_keys(
    records: DataFrame, settings: LinkSettings, model: LinkModel, threshold: float, all_records: Sequence[DataFrame] | None
) -> DataFrame | None:
    """Keys whose holders all match: `key_0`, `key_1`, `id`, `side`, `sides`, and the values.

    A requirement is a least set of columns that must agree, and of columns that must
    not differ. Take two records with given sets of filled columns: they meet the
    requirement if and only if they share the values of what both have. So records
    with filled sets a and b hold the key of the unordered pair {a, b} and those
    values; those of different sides match. For a = b there is one side, and all its
    holders match each other. No two other records share a key so.
    """
    for c in settings.compare:
        if model.m[c] < model.u[c]:
            raise ValueError(f"linkage: agreement on {c} lowers the score; leave it out")
    patterns = _predicted(settings, model, threshold)
    if not patterns:
        return None
    bits = list(zip(settings.compare, _bits(settings.compare)))
    have = reduce(add, [F.when(F.col(c).isNotNull(), bit).otherwise(0) for c, bit in bits])
    # Which keys a record holds follows from its filled columns alone, so the table has a
    # bounded number of rows and may be broadcast; keys that no two records of `all_records`
    # can share are left out of it.
    seen: Collection[int] = range(1 << len(settings.compare))
    if all_records is not None:
        found = reduce(DataFrame.union, [df.select(have.alias("have")).distinct() for df in all_records]).distinct()
        seen = {r["have"] for r in found.collect()}
    held = records.sparkSession.createDataFrame(
        _held_keys(patterns, len(settings.compare), seen),
        "have int, link int, shared int, side int, sides int",
    )
    # The link says which columns the key holds, and these are not null, so leaving the
    # other columns out of the hash makes no two contents alike. Two hashes of 64 bits
    # with their own seeds stand for the content: narrow rows to shuffle, and by chance
    # one false match in 10^15 runs over 10^12 keys.
    content = [
        F.col("link"), *[F.col(c) for c in settings.block],
        *[F.when(F.col("shared").bitwiseAND(F.lit(bit)) != 0, F.col(c)) for c, bit in bits],
    ]
    return records.withColumn("have", have).join(F.broadcast(held), "have").select(
        *[F.xxhash64(F.lit(seed), *content).alias(key) for seed, key in enumerate(KEY)],
        F.col(settings.unique_id).alias("id"), "side", "sides",
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(settings.compare)],
    )


def _held_keys(patterns: Sequence[Pattern], k: int, seen: Collection[int]) -> list[tuple[int, int, int, int, int]]:
    """Rows (filled set, link, columns whose values the key holds, side, sides) for the filled sets that are `seen`."""
    rank = {DIFFER: 0, MISSING: 1, AGREE: 2}

    def below(p: Pattern, q: Pattern) -> bool:
        return p != q and all(rank[a] <= rank[b] for a, b in zip(p, q))

    rows, link = [], 0
    for need in (p for p in patterns if not any(below(q, p) for q in patterns)):
        agreed, loose = _mask(need, (AGREE,)), _mask(need, (MISSING,))
        # the filled sets that meet the need, by what they have of its loose columns
        by_loose: dict[int, list[int]] = {}
        for have in sorted(seen):
            if have & agreed == agreed:
                by_loose.setdefault(have & loose, []).append(have)
        for a, b in combinations_with_replacement(sorted(by_loose), 2):
            link += 1
            for side, own in enumerate([a] if a == b else [a, b]):
                rows += [(have, link, agreed | a & b, side, 1 if a == b else 2) for have in by_loose[own]]
    return rows
