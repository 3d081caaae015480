"""Near-duplicate vectors: cover trees, traversed in pairs, find exactly the pairs above a cosine threshold.

Equal vectors of a label are one point with a count. The points of a label are dealt to cells around pivots, the upper
level of the tree; a point also visits every cell that can hold a partner of it, by the triangle inequality, so each
cell sees all partners of its own points. Within a cell a cover tree with halving radii is walked by pairs of nodes: a
pair is dropped when its covering radii prove all distances too large, and taken whole when they prove all small
enough; only pairs in between are opened, down to leaves that are compared by dot products.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

COSINE = 0.98
#: Points to a pivot, about, and the pivots at most. A cell with more than BLOCK points is dealt in blocks: its own
#: points by blocks against all blocks of its points and visitors, each pair of blocks a task's unit.
CELL_POINTS, MAX_PIVOTS, BLOCK = 4000, 4096, 4000
#: Points of a leaf, which is compared by one matrix product, and the least mean size of children worth a level: where
#: a level would leave nearly every point a child of its own (far apart in many dimensions), leaves are cut as they come.
LEAF, SPARSE = 128, 6
#: Distances nearer to the threshold than this are decided by the cosine in double precision itself.
SLACK = 1e-6


class Node:
    """Points ``members`` (all below), with a centre, the largest distance to it, and children or none."""

    __slots__ = ("centre", "radius", "members", "children")

    def __init__(self, x: np.ndarray, centre: int, members: np.ndarray, level: int):
        d = distances(x, members, x[centre])
        self.centre, self.members = centre, members
        self.radius = float(d.max())
        self.children: list[Node] = []
        if len(members) <= LEAF or self.radius == 0:
            return
        # nested levels: the centre covers what is within the level's radius, the rest gets centres of its own
        while 2.0**level >= self.radius and level > -40:
            level -= 1
        reach = 2.0**level
        rest, c, dist = members, centre, d
        covered: list[tuple[int, np.ndarray]] = []
        while len(rest):
            inside = dist <= reach
            covered.append((c, rest[inside]))
            rest = rest[~inside]
            if len(covered) > 16 and len(members) - len(rest) < SPARSE * len(covered):
                break
            if len(rest):
                c = int(rest[0])
                dist = distances(x, rest, x[c])
        loose = [rest] if len(rest) else []
        for c, some in covered:
            if len(some) >= SPARSE or len(covered) <= 4:
                self.children.append(Node(x, c, some, level - 1))
            else:
                loose.append(some)
        if loose:
            flat = np.concatenate(loose)
            self.children += [Node(x, int(p[0]), p, -41) for p in np.array_split(flat, -(-len(flat) // LEAF))]


def distances(x: np.ndarray, members: np.ndarray, to: np.ndarray) -> np.ndarray:
    diff = x[members] - to
    return np.sqrt((diff * diff).sum(1))


def cosines(raw: np.ndarray, norms: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all pairs of rows a and b, as the plain double-precision sum of products over the norms."""
    return (raw[a] @ raw[b].T) / (norms[a][:, None] * norms[b][None, :])


class Forest:
    """Classes of linked rows, joined by arrays of links; of the links only a spanning forest is kept."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while len(moved := np.flatnonzero((up := self.parent[found]) != found)):
            found[moved] = up[moved]
        self.parent[rows] = found
        return found

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            # of several links of one root the last counts in this round; the others come again
            self.parent[np.maximum(x, y)] = np.minimum(x, y)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return rows, self.roots(rows)


def dual_join(raw: np.ndarray, own: np.ndarray, weight: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, Forest]:
    """For rows of which ``own`` are the cell's: the weights of partners of each own row, itself left out, and the
    classes of rows that own rows link. Memory follows the rows and not the pairs."""
    n = len(raw)
    norms = np.sqrt((raw * raw).sum(1))
    x = raw / norms[:, None]
    limit = np.sqrt(2 - 2 * cosine)
    mine = np.flatnonzero(own)
    total = np.zeros(n, np.int64)
    forest = Forest(n)
    if not len(mine):
        return total, forest
    everyone = np.arange(n)
    top = int(np.ceil(np.log2(2.0))) + 1
    left, right = Node(x, int(mine[0]), mine, top), Node(x, 0, everyone, top)
    todo = [(left, right)]
    while todo:
        p, q = todo.pop()
        d = float(np.sqrt(((x[p.centre] - x[q.centre]) ** 2).sum()))
        if d - p.radius - q.radius > limit + SLACK:
            continue
        if d + p.radius + q.radius < limit - SLACK:  # all pairs: a star joins them
            total[p.members] += int(weight[q.members].sum())
            forest.link(q.members, np.full(len(q.members), p.centre))
            forest.link(p.members, np.full(len(p.members), q.centre))
            continue
        if p.children and (p.radius >= q.radius or not q.children):
            todo += [(c, q) for c in p.children]
        elif q.children:
            todo += [(p, c) for c in q.children]
        else:
            near = cosines(raw, norms, p.members, q.members) >= cosine
            total[p.members] += near @ weight[q.members]
            near &= forest.roots(p.members)[:, None] != forest.roots(q.members)[None, :]
            i, j = np.nonzero(near)
            forest.link(p.members[i], q.members[j])
    # every own row has met itself, once: its cosine is 1, or so near that it is taken as linked
    total[mine] -= weight[mine]
    return total, forest


def scaled(v: Column) -> Column:
    """By the power of two that brings the largest component near to 1: no square, product or norm then leaves the range of
    doubles, and cosines stay what they are, bit by bit, where they could be computed before. In two factors, as one may
    be out of range itself."""
    power = F.floor(F.log2(F.array_max(F.transform(v, F.abs)))).cast("int")
    half = F.floor(power / 2).cast("int")
    # bound once a row: an expression within a lambda is computed for each component
    bound = F.array(F.struct(v.alias("v"), F.pow(F.lit(2.0), -half).alias("a"), F.pow(F.lit(2.0), half - power).alias("b")))
    return F.get(F.transform(bound, lambda s: F.transform(s["v"], lambda x: x * s["a"] * s["b"])), F.lit(0))


def points(df: DataFrame, vector_col: str, id_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, points): rows (vec_id, point or null) of all rows; points (point, label, vector, copies, id), one for each
    distinct usable vector of a label, vectors that differ by a power of two being one. point is a 64-bit hash of both."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    usable = ok & finite & nonzero
    plain = scaled(F.transform(v, lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    rows = df.select(F.col(id_col).alias("vec_id"), F.when(usable, plain).alias("vector"), F.col(label_col).alias("label"))
    rows = rows.withColumn("point", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    distinct = rows.where("point is not null").groupBy("point").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("id"))
    return rows.select("vec_id", "point"), distinct


def pivots(some: DataFrame, per_pivot: int = CELL_POINTS, limit: int = MAX_PIVOTS) -> dict:
    """label and size -> centres, chosen by hash: about one for ``per_pivot`` points, at most ``limit`` in all labels.
    They set how the work is cut, not the result."""
    counts = {(r["label"], r["k"]): r["n"] for r in some.groupBy("label", F.size("vector").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(limit).collect()}
    total = sum(counts.values())
    rate = min(1.0, 1 / per_pivot, limit / max(1, total))
    picked = some.where(F.pmod(F.xxhash64("point", F.lit(7)), F.lit(1_000_000)) < int(rate * 1_000_000)).select("label", "vector").limit(2 * limit).collect()
    out: dict = {}
    for r in picked:
        v = np.array(r["vector"])
        out.setdefault((r["label"], len(v)), []).append(v / np.sqrt((v * v).sum()))
    return {k: np.array(v) for k, v in out.items()}


def links(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row.

    Rows of equal labels are linked where the cosine is at least ``cosine``; n_links counts the other rows linked,
    copies included, component_id is the least id that can be reached. Vectors that are null, empty, zero or hold a null
    or a value that is not finite, and rows with a null label, are linked with nothing. Finite components may be as large
    or as small as doubles are. Vectors of different lengths are
    not compared. Repeated rows are rows of their own. A null id stays null and is kept if its component has no id.
    """
    rows, distinct = points(df, vector_col, id_col, label_col)
    rows, distinct = common.staged(rows, "cover-rows"), common.staged(distinct, "cover-points")
    centres = pivots(distinct)
    reach = float(np.sqrt(2 - 2 * cosine))
    label_type = distinct.schema["label"].dataType
    cell_schema = T.StructType([T.StructField("label", label_type), T.StructField("cell", T.LongType()), T.StructField("own", T.BooleanType()), *(distinct.schema[c] for c in ("point", "vector", "copies"))])

    def assign(batch):
        labels, vectors = batch.column(1).to_pylist(), batch.column(2)
        out: list[list] = [[] for _ in range(6)]
        for i, label in enumerate(labels):
            v = np.array(vectors[i].as_py())
            pivot = centres.get((label, len(v)))
            if pivot is None:
                cells, home = [0], 0
            else:
                squares = np.maximum(0, 2 - 2 * (pivot @ (v / np.sqrt((v * v).sum()))))
                home = int(squares.argmin())
                # a partner whose home is c lies beyond the plane halfway between the pivots: how far is it to there?
                apart = np.sqrt(np.maximum(0, 2 - 2 * (pivot @ pivot[home])))
                cells = np.flatnonzero(squares - squares[home] <= 2 * apart * (reach + SLACK) + SLACK).tolist()
            for c in cells:
                for column, value in zip(out, (label, len(v) * 1_000_000 + c, c == home, batch.column(0)[i].as_py(), vectors[i].as_py(), batch.column(3)[i].as_py())):
                    column.append(value)
        return common.batch(cell_schema, out)

    placed = common.staged(common.map_batches(distinct.select("point", "label", "vector", "copies"), assign, cell_schema), "cover-cells")
    sizes = placed.groupBy("label", "cell").agg(F.count("*").alias("n"), F.count_if("own").alias("n_own"))
    sizes = sizes.select("label", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n_own") / BLOCK).cast("int").alias("own_blocks"))
    dealt = placed.join(sizes.where("own_blocks > 0"), ["label", "cell"])
    # a pair of blocks is a unit: own block i against block j
    h = F.xxhash64("point", F.lit(3))
    own = dealt.where("own").withColumn("i", F.pmod(h, F.col("own_blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    other = dealt.withColumn("j", F.pmod(h, F.col("blocks")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)))
    units = own.select("label", "cell", "i", "j", F.lit(True).alias("mine"), "point", "vector", "copies").unionAll(other.select("label", "cell", "i", "j", F.lit(False).alias("mine"), "point", "vector", "copies"))

    found_schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("n", T.LongType())])

    def join(table):
        import pyarrow as pa

        mine = table.column("mine").to_numpy(zero_copy_only=False)
        names, copies = table.column("point").to_numpy(), table.column("copies").to_numpy()
        vectors = table.column("vector").combine_chunks()
        raw = vectors.values.to_numpy().reshape(len(names), -1)
        # an own point may be there twice, as one that asks and as one that is asked: names tell
        ask, give = np.flatnonzero(mine), np.flatnonzero(~mine)
        unique, at = np.unique(names, return_index=True)
        place = np.searchsorted(unique, names)
        own_ = np.zeros(len(unique), bool)
        own_[place[ask]] = True
        present = np.zeros(len(unique), bool)
        present[place[give]] = True
        weight = np.where(present, copies[at], 0)
        total, forest = dual_join(raw[at], own_, weight, cosine)
        some = np.flatnonzero(own_)
        total = total[some] + np.where(present[some], 0, weight[some])
        a, b = forest.edges()
        asked, linked = unique[some], unique[a]
        return pa.table([pa.array(np.concatenate([asked, linked])), pa.concat_arrays([pa.nulls(len(asked), pa.int64()), pa.array(unique[b])]), pa.array(np.concatenate([total, np.zeros(len(a), np.int64)]))], names=["a", "b", "n"])

    found = common.staged(units.groupBy("label", "cell", "i", "j").applyInArrow(join, found_schema), "cover-found")
    partners = found.where("b is null").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("partners"))
    labels = common.components(found.where("b is not null").select("a", "b"), "cover-components")
    named = distinct.select("point", "id", "copies").join(labels.withColumnRenamed("node", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component").join(partners, "point", "left").select("point", (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(named, "point", "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.col("point").isNull() | F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), kept.alias("kept"))
