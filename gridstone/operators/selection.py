"""Ordered exact-quota selection and deterministic train/test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_FLOOR, Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.identity import canonical_hash, json_object, json_string, sha256


class QuotaError(ValueError):
    """A strict quota could not be filled."""


def cutoffs(df: DataFrame, group: Column, rank: str, ties: Sequence[str], quota: Mapping[object, int]) -> dict[object, tuple | None]:
    """The last (rank, *ties) within each group's quota; None: all of the group.

    Ranks are hexadecimal digests.  Their first four digits are counted, which
    gives at most 65,536 rows a group whatever the input, and only the rows of
    the bucket in which a quota ends are put in order.
    """
    rows = df.select(group.alias("__g"), F.substring(rank, 1, 4).alias("__b"), rank, *ties)
    counts: dict[object, list[tuple[str, int]]] = {}
    for r in rows.groupBy("__g", "__b").count().collect():
        counts.setdefault(r["__g"], []).append((r["__b"], r["count"]))
    out: dict[object, tuple | None] = {}
    edges: list[tuple[object, str, int]] = []
    for g, n in quota.items():
        rest = n
        for bucket, size in sorted(counts.get(g, ())):
            if rest <= size:
                edges.append((g, bucket, rest))
                break
            rest -= size
        else:
            out[g] = None
    if edges:
        here = lambda g, bucket: F.col("__g").eqNullSafe(F.lit(g)) & (F.col("__b") == bucket)
        place = F.row_number().over(Window.partitionBy("__g").orderBy(rank, *ties))
        edge = rows.where(reduce(or_, [here(g, x) for g, x, _ in edges])).withColumn("__n", place)
        edge = edge.where(reduce(or_, [F.col("__g").eqNullSafe(F.lit(g)) & (F.col("__n") == n) for g, _, n in edges]))
        out |= {r["__g"]: (r[rank], *(r[c] for c in ties)) for r in edge.collect()}
    return out


def _within(columns: Sequence[Column], cut: tuple | None) -> Column:
    named = lambda cs: F.struct(*(c.alias(f"c{i}") for i, c in enumerate(cs)))
    return F.lit(True) if cut is None else named(columns) <= named(map(F.lit, cut))


def select_quotas(df: DataFrame, identity: Sequence[str], rules: Sequence[tuple[str, int, Column]], seed: int, source_json: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(candidates, audits) of ordered rules (name, quota, matches).

    A rule ranks its matches by SHA-256 of canonical JSON over rule, scene,
    seed and source, skips what prior rules claimed and takes its quota.
    candidates: identity, rule_index, rule_name, rank, claimed, selected,
    reason; audits: one row a rule.

    What a rule takes is all it may take up to one rank, so each rule leaves a
    literal, and the whole outcome is one projection of ``df``: the plan grows
    by a column a rule.
    """
    token = identity[0]
    ranked, taken = df, F.lit(False)
    outcome = []
    for i, (name, quota, match) in enumerate(rules):
        at = f"__rank{i}"
        rank = sha256(json_object(rule_index=i, rule_name=name, scene_token=json_string(F.col(token)), seed=seed, source=source_json))
        ranked = ranked.withColumn(at, F.when(match, rank))
        free = F.col(at).isNotNull() & ~taken
        if quota > 0:
            cut = cutoffs(ranked.where(free), F.lit(0), at, list(identity), {0: quota})[0]
            picked = free & _within([F.col(at), *map(F.col, identity)], cut)
        else:
            picked = F.lit(False)
        outcome.append(F.when(F.col(at).isNotNull(), F.struct(F.lit(i).alias("rule_index"), F.lit(name).alias("rule_name"), F.col(at).alias("rank"), taken.alias("claimed"), picked.alias("selected"))))
        ranked = ranked.withColumn(f"__taken{i}", taken | picked)
        taken = F.col(f"__taken{i}")
    found = ranked.select(*identity, F.explode(F.array_compact(F.array(*outcome))).alias("__r")).select(*identity, "__r.*")
    reason = F.when(F.col("selected"), "selected").when(F.col("claimed"), "claimed_by_prior_rule").otherwise("quota_filled")
    candidates = found.withColumn("reason", reason)
    asked = df.sparkSession.createDataFrame([(name, i, quota) for i, (name, quota, _) in enumerate(rules)], "rule_name string, rule_index int, quota long")
    counted = candidates.groupBy("rule_index").agg(F.count(F.lit(1)).alias("matched"), F.count_if(~F.col("claimed")).alias("eligible"), F.count_if("selected").alias("selected"))
    audits = asked.join(counted, "rule_index", "left").na.fill(0, ["matched", "eligible", "selected"])
    audits = audits.select("rule_name", "rule_index", "quota", "matched", "eligible", "selected", (F.col("quota") - F.col("selected")).alias("deficit"))
    if strict:
        short = audits.where("deficit > 0").orderBy("rule_index").limit(1).collect()
        if short:
            raise QuotaError(f"rule {short[0]['rule_name']} lacks {short[0]['deficit']} scenes")
    return candidates, audits


def unselected(df: DataFrame, candidates: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Scenes no rule took, with why: no_rule_match or quota_filled."""
    seen = candidates.groupBy(*identity).agg(F.bool_or("selected").alias("__s"))
    left = df.select(*identity).join(seen, list(identity), "left").where("not coalesce(__s, false)")
    return left.select(*identity, F.when(F.col("__s").isNull(), "no_rule_match").otherwise("quota_filled").alias("reason"))


def apportion(sizes: Mapping[str, int], fraction: str, seed: int) -> dict[str, int]:
    """Test quotas by stratum that add up to floor(n * fraction + 0.5): floors,
    then one more in order of the remainder, ties by hash and then name.

    A stratum of two or more should stand on both sides.  For either side, in
    turn, each stratum that lacks it swaps one scene with a stratum that can
    spare one: first by the hash of the swap.
    """
    share = Decimal(fraction)
    exact = {s: Decimal(n) * share for s, n in sizes.items()}
    test = {s: int(x.to_integral_value(ROUND_FLOOR)) for s, x in exact.items()}
    target = int((sum(map(Decimal, sizes.values()), Decimal(0)) * share + Decimal("0.5")).to_integral_value(ROUND_FLOOR))
    tie = lambda s: canonical_hash({"primary_scenario": s, "purpose": "apportion", "seed": seed})
    first = sorted(sizes, key=lambda s: (test[s] - exact[s], tie(s), s))
    for s in first[: max(0, target - sum(test.values()))]:
        test[s] += 1
    sides = {"test": test, "train": {s: n - test[s] for s, n in sizes.items()}}
    for lacked, other in (("test", "train"), ("train", "test")):
        have, rest = sides[lacked], sides[other]
        for needy in sorted(s for s, n in sizes.items() if n > 1 and not have[s]):
            offers = [s for s, n in sizes.items() if have[s] > (1 if n > 1 else 0)]
            # a test scene's place goes from one stratum to the other
            way = (lambda s, to=needy: (s, to)) if lacked == "test" else (lambda s, of=needy: (of, s))
            swap = lambda s, way=way: canonical_hash(dict(zip(("from", "to"), way(s), strict=True)) | {"purpose": "rebalance", "seed": seed})
            if offers:
                giver = min(offers, key=swap)
                for s, step in ((needy, 1), (giver, -1)):
                    have[s] += step
                    rest[s] -= step
    return test


def split_rank(seed: int, stratum: Column | str, token: Column, source: Column) -> Column:
    stratum = json_string(stratum) if isinstance(stratum, Column) else stratum
    return sha256(json_object(primary_scenario=stratum, scene_token=json_string(token), seed=seed, source_digest=json_string(source)))


def split_scenes(df: DataFrame, token: str, source: str, fraction: str, seed: int, stratum: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(``df`` with rank and split, strata audit).

    Strata are few: their counts come to the driver, and the rank up to which
    each stratum's scenes are test goes back as a literal.
    """
    group = F.col(stratum) if stratum else F.lit("__all__")
    ranked = df.withColumn("__g", group).withColumn("rank", split_rank(seed, F.col("__g"), F.col(token), F.col(source)))
    sizes = {r["__g"]: r["count"] for r in ranked.groupBy("__g").count().collect()}
    quota = {s: n for s, n in apportion(sizes, fraction, seed).items() if n}
    order = ["rank", token, source]
    picked = [F.col("__g").eqNullSafe(F.lit(s)) & _within([*map(F.col, order)], cut) for s, cut in cutoffs(ranked, F.col("__g"), "rank", order[1:], quota).items()]
    out = ranked.withColumn("split", F.when(reduce(or_, picked, F.lit(False)), "test").otherwise("train"))
    audit = out.groupBy(F.col("__g").alias("stratum")).agg(F.count(F.lit(1)).alias("population"), F.count_if(F.col("split") == "test").alias("test"), F.count_if(F.col("split") == "train").alias("train"))
    alone = F.when(F.col("population") < 2, "stratum_too_small").when((F.col("test") == 0) | (F.col("train") == 0), "global_target_prevents_both_sides")
    return out.drop("__g"), audit.withColumn("fallback", alone)


def leakage_pairs(df: DataFrame, source: str, order: Sequence[str], token: str, split: str) -> DataFrame:
    """Neighbouring scenes of a recording in different splits."""
    w = Window.partitionBy(source).orderBy(*order)
    pairs = df.withColumns({"next_token": F.lead(token).over(w), "next_split": F.lead(split).over(w)})
    return pairs.where(F.col("next_split").isNotNull() & (F.col("next_split") != F.col(split))).select(source, F.col(token).alias("token"), F.col(split).alias("split"), "next_token", "next_split")
