"""Entities: canonical part numbers, parsed model codes, supplier clusters."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle import config
from brindle.functions import shared
from brindle.functions import text as t
from brindle.operators import axioms


def parse_model(c: Column) -> Column:
    """Struct of model_name, grade_suffix and region; nulls where the code has another form."""
    code = F.upper(t.ustrip(c))
    ok = code.rlike(config.MODEL_PARTS)
    name, suffix = F.regexp_extract(code, config.MODEL_PARTS, 1), F.regexp_extract(code, config.MODEL_PARTS, 2)
    region: Column = F.lit(None).cast("string")
    for n in sorted({len(r) for r in config.REGIONS}):
        tail = F.right(suffix, F.lit(n))
        region = F.when(tail.isin(*(r for r in config.REGIONS if len(r) == n)), tail).otherwise(region)
    rest = F.when(region.isNotNull(), F.substring(suffix, F.lit(1), F.length(suffix) - F.length(region))).otherwise(suffix)
    null = F.lit("")
    return F.struct(F.when(ok, F.nullif(name, null)).alias("model_name"), F.when(ok, F.nullif(rest, null)).alias("grade_suffix"), F.when(ok, region).alias("region"))


def resolve_parts(df: DataFrame) -> DataFrame:
    return df.withColumn("canonical_part_no", F.nullif(axioms.normalize_part_no(F.col("base_part_no")), F.lit("")))


def resolve_models(df: DataFrame) -> DataFrame:
    df = df.withColumn("_model", parse_model(F.col("model_code")))
    return df.withColumns({"model_name": F.col("_model.model_name"), "model_grade_suffix": F.col("_model.grade_suffix"), "model_region": F.col("_model.region")}).drop("_model")


def cluster(values: list[str], threshold: float = 0.9) -> dict[str, str]:
    """value -> canonical: sorted values join the group whose first member is most alike, or start one; the longest member stands for it."""
    groups: list[tuple[str, list[str]]] = []
    for v in sorted(set(values)):
        plain = " ".join(v.lower().split())
        best = max(groups, key=lambda g: t.indel(plain, g[0]), default=None)
        if best is not None and t.indel(plain, best[0]) >= threshold:
            best[1].append(v)
        else:
            groups.append((plain, [v]))
    return {v: max(members, key=len) for _, members in groups for v in members}


@F.pandas_udf(T.StringType())
def _plain(s: pd.Series) -> pd.Series:
    return s.map(lambda v: " ".join(v.lower().split()))


def _grams(q: int):
    """Each q-gram with the number of its occurrence, so that shared grams count as in multisets."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        def of(v: str) -> list[str]:
            v, seen, out = "\0" * (q - 1) + v + "\0" * (q - 1), Counter(), []
            for i in range(len(v) - q + 1):
                g = v[i : i + q]
                seen[g] += 1
                out.append(f"{g}{seen[g]}")
            return out

        return s.map(of)

    return run


def kept(df: DataFrame) -> DataFrame:
    """Checkpointed in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared.folder(df.sparkSession))
    return df.checkpoint()


def alike(forms: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, b, score) of the pairs of different ``plain`` forms whose Indel ratio reaches the threshold, both ways round.

    With padding, strings of lengths m and n whose longest common subsequence is L share (2q - 1) L - (q - 1) (m + n) + q - 1
    q-grams at least: a lost sign breaks q grams and an added one q - 1. From L >= t (m + n) / 2 follow a least number of
    shared grams, positive for the q chosen here, and for each string a prefix of its rarest grams that meets the other's.
    """
    q = 3 if threshold >= 0.8 else 2 if threshold >= 2 / 3 else 1
    slope = (2 * q - 1) * threshold / 2 - (q - 1)
    n = F.length("plain")
    need = F.ceil(2 * slope / (2 - threshold) * n + (q - 1) - 1e-9)  # for the shortest string that can be alike
    grams = forms.select("plain", F.explode(_grams(q)("plain")).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n"))
    sorted_ = grams.join(counted, "gram").groupBy("plain").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    prefix = sorted_.select("plain", F.explode(F.slice("grams", F.lit(1), F.greatest(F.lit(1), n + (q - 1) - need + 1).cast("int"))).alias("g")).select("plain", "g.gram")
    m = F.length("b")
    bound = threshold / (2 - threshold) * F.greatest(F.length("a"), m) - 1e-9
    pairs = prefix.withColumnRenamed("plain", "a").join(prefix.withColumnRenamed("plain", "b"), "gram").where((F.col("a") != F.col("b")) & (F.least(F.length("a"), m) >= bound))
    return pairs.select("a", "b").distinct().withColumn("score", t.indel_ratio("a", "b")).where(F.col("score") >= threshold)


def resolve_suppliers(df: DataFrame, column: str, threshold: float = 0.9) -> DataFrame:
    """Rows (value, canonical) of the distinct values, as by ``cluster`` over all of them; threshold above 0.

    A form starts a group if no earlier alike form has. That is settled in rounds over the alike pairs: forms without an
    open earlier neighbour start groups, and their neighbours are members. Each round settles the first open form at least.
    """
    values = kept(df.where(~t.blank(F.col(column))).select(F.col(column).alias("value")).distinct().withColumn("plain", _plain("value")))
    forms = values.groupBy("plain").agg(F.min("value").alias("first"))
    pairs = kept(alike(forms, threshold))
    first = lambda side: forms.select(F.col("plain").alias(side), F.col("first").alias(f"first_{side}"))
    edges = kept(pairs.join(first("a"), "a").join(first("b"), "b").where("first_a < first_b").select("a", "b"))
    members = None
    while not edges.isEmpty():
        new = edges.select("a").distinct().join(edges.select(F.col("b").alias("a")), "a", "left_anti")
        joined = kept(edges.join(new, "a").select("b").distinct())
        members = joined if members is None else members.unionAll(joined)
        gone = joined.select(F.col("b").alias("x"))
        edges = kept(edges.join(gone, F.col("b") == F.col("x"), "left_anti").join(gone, F.col("a") == F.col("x"), "left_anti"))
    heads = forms if members is None else forms.join(members.withColumnRenamed("b", "plain"), "plain", "left_anti")
    heads = heads.select(F.col("plain").alias("head"), "first")
    own = values.join(heads, F.col("plain") == F.col("head")).select("value", "head", "first", F.lit(1.0).alias("score"))
    other = values.join(pairs, F.col("plain") == F.col("a")).join(heads, F.col("b") == F.col("head")).where(F.col("first") <= F.col("value")).select("value", "head", "first", "score")
    best = own.unionAll(other).groupBy("value").agg(F.min(F.struct((-F.col("score")).alias("s"), "first", "head")).alias("m")).select("value", "m.head")
    longest = best.groupBy("head").agg(F.min(F.struct((-F.length("value")).alias("n"), "value")).alias("m")).select("head", F.col("m.value").alias("canonical"))
    return best.join(longest, "head").select("value", "canonical")
