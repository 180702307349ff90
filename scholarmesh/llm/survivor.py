"""Problem 7: one surviving record per duplicate group, by consistent bundles."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from scholarmesh.runtime import cut, small_side

#: Trust of a record whose source is unknown: after every named source.
UNKNOWN = 2_147_483_647

# Fixed value: the forms of the three fields. Look-arounds keep a longer run of digits from passing for an identifier.
EMAIL = r"(?<![A-Za-z0-9._%+\-@])([A-Za-z0-9_%+\-]+(?:\.[A-Za-z0-9_%+\-]+)*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,})(?![A-Za-z0-9\-@])"
ORCID = r"(?<![0-9\-])([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])(?![0-9X\-])"
RESEARCHER = r"(?<![A-Za-z0-9\-])([A-Z]-[0-9]{4}-[0-9]{4})(?![0-9\-])"


def usable(column: Column, pattern: str) -> Column:
    """The bare value in a field, or null if it's blank, filler (one digit repeated throughout) or malformed."""
    found = F.regexp_extract(column, pattern, 1)
    digits = F.regexp_replace(found, "[^0-9]", "")
    filler = ~F.contains(found, F.lit("@")) & digits.rlike(r"^(\d)\1*$")
    return F.when((found != "") & ~filler, found)


#: Cost of leaving a bundle out: more than that of any choice.
LEFT_OUT = 1 << 40


def _search(lists: list[list[str]], allowed: dict[tuple[int, int], tuple[set, set]]) -> tuple[int, list[int | None]]:
    """Branch and bound: one position of each list, of least sum, so that each dependency holds.

    lists: values by falling trust; a position is its cost. allowed: for a dependency (a, b), the values of a that
    were seen with any b, and the pairs seen together. Where dependencies can't all be met, as few bundles as can be
    are left out (None), each at a cost above that of any choice. The first of equal choices is kept.
    """
    best: list = [None, None]

    def fits(chosen: list[int | None]) -> bool:
        k = len(chosen) - 1
        for (a, b), (known, pairs) in allowed.items():
            if max(a, b) == k and chosen[a] is not None and chosen[b] is not None:
                x, y = lists[a][chosen[a]], lists[b][chosen[b]]
                if x in known and (x, y) not in pairs:
                    return False
        return True

    def down(chosen: list[int | None], cost: int) -> None:
        k = len(chosen)
        if k == len(lists):
            if best[0] is None or cost < best[0]:
                best[0], best[1] = cost, list(chosen)
            return
        for i in [*range(len(lists[k])), None]:
            more = cost + (LEFT_OUT if i is None else i)
            if best[0] is not None and more >= best[0]:  # the rest costs at least 0
                return
            chosen.append(i)
            if fits(chosen):
                down(chosen, more)
            chosen.pop()

    down([], 0)
    return best[0], best[1]


def candidates(records: DataFrame, group: str, bundles: Mapping[str, Sequence[Column]], trust: Column, recent: Column) -> DataFrame:
    """(group, bundle, value, best): each distinct whole bundle with its most trusted, then latest record.

    A bundle of which every part is null is no candidate; one with some parts null is, after complete ones of the
    same source. The value is one string: the only part itself, or a JSON object of the parts.
    """
    rows = []
    for name, parts in bundles.items():
        missing = sum((p.isNull().cast("int") for p in parts), F.lit(0))
        rows.append(F.struct(F.lit(name).alias("bundle"), _value(parts).alias("value"), missing.alias("missing")))
    late = F.coalesce(-F.unix_micros(recent), F.lit(9_223_372_036_854_775_807))
    melted = records.select(F.col(group).alias("_g"), F.coalesce(trust, F.lit(UNKNOWN)).alias("_t"), late.alias("_l"), F.explode(F.array(*rows)).alias("b")).filter("b.value is not null and _g is not null")
    return melted.groupBy("_g", F.col("b.bundle").alias("bundle"), F.col("b.value").alias("value")).agg(F.min(F.struct("_t", F.col("b.missing").alias("missing"), "_l")).alias("best"))


def _value(parts: Sequence[Column]) -> Column:
    """A bundle as one string: the only part itself, or a JSON object of the parts; null where every part is."""
    if len(parts) == 1:
        return parts[0].cast("string")
    return F.when(F.coalesce(*[p.cast("string") for p in parts]).isNotNull(), F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])))


def consistent_bundles(records: DataFrame, group: str, bundles: Mapping[str, Sequence[Column]], trust: Column, recent: Column, depends: Sequence[tuple[str, str]] = (), width: int = 16) -> DataFrame:
    """The surviving value of each bundle of each group, as (group, bundle, value).

    A bundle is a list of columns that are taken from one record together. Candidates are ordered by trust (smaller
    is better), completeness, recency and value; per group, branch and bound chooses the bundles of the least sum of
    positions such that, for each dependency (a, b) in `depends`, the chosen value of b was recorded together with the
    chosen value of a. Of a bundle in no dependency only the first candidate can be in an optimum (any other costs more
    and allows nothing more), so no other is brought to the search; it's found by an aggregation that combines first.

    Bundles in dependencies are searched over their `width` best candidates first. A found sum that is no larger than
    `width` can't be beaten by a candidate further down, so it's proven; groups not proven are searched again with
    width * 8, until all are proven or complete. So no group is gathered whole unless its proof needs it.
    In a group whose dependencies can't all be met, as few bundles as can be are left without a row.
    Null groups are left out; unknown trust and unknown time come last; equal rows count once; no records give no rows.
    """
    names = list(bundles)
    bound = [n for n in names if any(n in pair for pair in depends)]
    cand = candidates(records, group, bundles, trust, recent)
    first = cand.filter(~F.col("bundle").isin(*bound)) if bound else cand
    first = first.groupBy("_g", "bundle").agg(F.min(F.struct("best", "value")).alias("w")).select("_g", "bundle", F.lit(1).alias("pos"), F.lit(1).cast("long").alias("n"), F.col("w.value").alias("value"))
    none = first.select("_g").limit(0).withColumns({"a": F.lit(0), "b": F.lit(0), "x": F.lit(""), "y": F.lit("")})
    together = none
    for a, b in depends:
        both = records.select(F.col(group).alias("_g"), F.lit(names.index(a)).alias("a"), F.lit(names.index(b)).alias("b"), _value(bundles[a]).alias("x"), _value(bundles[b]).alias("y"))
        together = together.unionByName(both.filter("_g is not null and x is not null and y is not null").distinct())
    todo = cut(cand.filter(F.col("bundle").isin(*bound))) if bound else None
    together = cut(together) if bound else together
    out_type = T.StructType([T.StructField("_g", first.schema["_g"].dataType), T.StructField("bundle", T.StringType()), T.StructField("value", T.StringType()), T.StructField("proven", T.BooleanType())])
    results = []
    while True:
        top = first
        if todo is not None:
            ordered = todo.groupBy("_g", "bundle").agg(F.count("*").alias("n"))
            some = todo.withColumn("pos", F.row_number().over(Window.partitionBy("_g", "bundle").orderBy("best", "value"))).filter(F.col("pos") <= width)
            top = top.unionByName(some.join(ordered, ["_g", "bundle"]).select("_g", "bundle", "pos", "n", "value"))
        packed = top.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("bundle", "pos", "value"))).alias("c"), F.max("n").alias("n"))
        if todo is not None:
            values = lambda name: top.select("_g", F.col("value").alias(name)).distinct()
            of = together.join(values("x"), ["_g", "x"], "left_semi")
            known = of.groupBy("_g").agg(F.collect_set(F.struct("a", "b", "x")).alias("known"))
            seen = of.join(values("y"), ["_g", "y"], "left_semi").groupBy("_g").agg(F.collect_set(F.struct("a", "b", "x", "y")).alias("seen"))
            packed = packed.join(known, "_g", "left").join(seen, "_g", "left")
        else:
            packed = packed.withColumns({"known": F.lit(None).cast("array<struct<a:int,b:int,x:string>>"), "seen": F.lit(None).cast("array<struct<a:int,b:int,x:string,y:string>>")})

        def solve(batches: Iterator[pd.DataFrame], width: int = width) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for g, c, n, kn, se in zip(pdf["_g"], pdf["c"], pdf["n"], pdf["known"], pdf["seen"]):
                    lists: dict[str, list[str]] = {}
                    for x in c:
                        lists.setdefault(x["bundle"], []).append(x["value"])
                    present = [k for k in names if k in lists]
                    allowed = {}
                    for a, b in depends:
                        if a in lists and b in lists:
                            pair = (names.index(a), names.index(b))
                            rows = lambda found, *keys: {tuple(x[k] for k in keys) for x in (found if found is not None else []) if (x["a"], x["b"]) == pair}  # noqa: B023, E731
                            allowed[present.index(a), present.index(b)] = ({x for (x,) in rows(kn, "x")}, rows(se, "x", "y"))
                    cost, chosen = _search([lists[k] for k in present], allowed)
                    if n <= width or cost <= width:
                        out += [(g, k, lists[k][i], True) for k, i in zip(present, chosen) if i is not None]
                    else:
                        out.append((g, None, None, False))
                yield pd.DataFrame(out, columns=["_g", "bundle", "value", "proven"])

        answer = packed.mapInPandas(solve, out_type)
        answer = cut(answer) if todo is not None else answer
        results.append(answer.filter("proven").select(F.col("_g").alias(group), "bundle", "value"))
        if todo is None:
            break
        open_groups = answer.filter("not proven").select("_g").distinct()
        if open_groups.isEmpty():
            break
        todo = cut(todo.join(open_groups, "_g", "left_semi"))
        first = first.join(open_groups, "_g", "left_semi")
        width *= 8
    return reduce(DataFrame.unionByName, results)


def with_groups(person: DataFrame, groups: DataFrame, source: DataFrame) -> DataFrame:
    """Records of grouped persons with group_id and trust_rank. groups has one row per person, person few."""
    ranked = source.groupBy("source").agg(F.min("trust_rank").alias("trust_rank"))
    members = groups.select("group_id", F.col("person_id").alias("id"))
    return person.join(members, "id").join(small_side(ranked), "source", "left")


def person_survivors(person: DataFrame, groups: DataFrame, source: DataFrame) -> DataFrame:
    """p7_found(person_id, field_name, field_value): each identifier is a bundle of its own, without dependencies."""
    r = with_groups(person.select("id", "email", "orcid_id", "researcher_id", "source", "updated_at"), groups, source)
    bundles = {"email": [usable(F.col("email"), EMAIL)], "orcid_id": [usable(F.col("orcid_id"), ORCID)], "researcher_id": [usable(F.col("researcher_id"), RESEARCHER)]}
    won = consistent_bundles(r, "group_id", bundles, F.col("trust_rank"), F.col("updated_at"))
    return won.select(F.col("group_id").alias("person_id"), F.col("bundle").alias("field_name"), F.col("value").alias("field_value"))


def person_golden(person: DataFrame, groups: DataFrame, source: DataFrame) -> DataFrame:
    """(person_id, field_name, field_value): the name parts as one bundle, taken from a record that also carries the
    chosen ORCID, and the e-mail address by itself."""
    r = with_groups(person.select("id", "firstname", "lastname", "publication_name", "email", "orcid_id", "source", "updated_at"), groups, source)
    bundles = {"name": [F.col("firstname"), F.col("lastname"), F.col("publication_name")], "orcid_id": [usable(F.col("orcid_id"), ORCID)], "email": [usable(F.col("email"), EMAIL)]}
    won = consistent_bundles(r, "group_id", bundles, F.col("trust_rank"), F.col("updated_at"), depends=[("orcid_id", "name")])
    return won.select(F.col("group_id").alias("person_id"), F.col("bundle").alias("field_name"), F.col("value").alias("field_value"))
