"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size says how often each of its documents is taken on average, from 0 to `most`. The whole part
is taken for certain; the rest is an inclusion probability. Flight phase: while more than two documents of a group are open,
three of them are moved along the null space of the two constraints (sum of tokens, number of documents) until one reaches 0
or 1, so both totals stay where they are. Groups of a source fly apart from each other; what a group leaves open (two documents
at most) flies again in groups of groups, until a source has LANDING left. Of all ways to round these, the one that keeps the
source's tokens nearest to their expected sum is taken. The order and every random choice come from a seeded hash, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galecast.llm.shared import stored
from galecast.llm.text import WORD

#: Sources in order of code point weigh these, over and over; the mix has this share of all tokens; no document is
#: taken more often than this.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Documents that fly together at first, and groups whose open rests fly together.
GROUP_ROWS = 4096
GROUP_FAN = 512
#: Tasks that the documents of one source are spread over where they meet their source's figures.
SALTS = 64
#: Open documents of a source that are rounded together in the end.
LANDING = 12
_EPS = 1e-9


def targets(sizes: list[tuple[str | None, int]], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Target tokens of each source: the mix by weight; what exceeds `most` times a source is dealt out anew by weight."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(order)}
    size = dict(order)
    left, total, out = set(size), share * sum(size.values()), {}
    while left:
        each = sum(weight[name] for name in left)
        over = {name for name in left if total * weight[name] / each > most * size[name]}
        if not over:
            return out | {name: total * weight[name] / each for name in left}
        for name in over:
            out[name] = float(most * size[name])
        total = share * sum(size.values()) - sum(out.values())
        left -= over
    return out


def fly(chance: np.ndarray, size: np.ndarray, random: np.ndarray, rest: int = 2) -> np.ndarray:
    """Chances moved until `rest` at most lie strictly between 0 and 1; sum(chance) and sum(chance * size) are kept."""
    p = chance.astype(float).copy()
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS)).tolist()
    open_.reverse()
    hand: list[int] = []
    k = 0
    while len(hand) + len(open_) > rest:
        while len(hand) < 3:
            hand.append(open_.pop())
        a, b, c = hand
        u, v, w = size[b] - size[c], size[c] - size[a], size[a] - size[b]
        if u == v == w == 0:
            u, v = 1.0, -1.0
        up = down = math.inf
        for i, step in ((a, u), (b, v), (c, w)):
            if step > 0:
                up, down = min(up, (1 - p[i]) / step), min(down, p[i] / step)
            elif step < 0:
                up, down = min(up, p[i] / -step), min(down, (1 - p[i]) / -step)
        by = up if random[k % len(random)] * (up + down) < down else -down
        k += 1
        for i, step in ((a, u), (b, v), (c, w)):
            p[i] += by * step
            if p[i] < _EPS or p[i] > 1 - _EPS:
                p[i] = round(p[i])
        hand = [i for i in hand if 0 < p[i] < 1]
    return p


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The open chances (LANDING at most) set to the 0s and 1s whose tokens, then documents, come nearest to the expected sums."""
    out, at = chance.copy(), np.flatnonzero((chance > 0) & (chance < 1))
    if len(at):
        each = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
        tokens, rows = np.abs(each @ size[at] - chance[at] @ size[at]), np.abs(each.sum(axis=1) - chance[at].sum())
        out[at] = each[np.lexsort((rows, np.round(tokens, 6)))[0]]
    return out


def _flight(df: DataFrame, group: str, landing: bool) -> DataFrame:
    def move(table: pa.Table) -> pa.Table:
        t = table.sort_by([("order", "ascending"), ("row", "ascending")])
        size, chance = t.column("size").to_numpy().astype(float), t.column("chance").to_numpy()
        random = (t.column("order").to_numpy().astype(np.int64) & 0xFFFFF) / float(1 << 20)
        p = fly(chance, size, random, LANDING if landing else 2)
        p = land(p, size) if landing else p
        return t.set_column(t.schema.get_field_index("chance"), "chance", pa.array(p, pa.float64()))

    return df.groupBy("source_key", group).applyInArrow(move, df.schema)


def sampled(docs: DataFrame, size: str, key: list[str], source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 11, group_rows: int = GROUP_ROWS) -> DataFrame:
    """key columns, source_size, target, row and copies of every row of docs; row numbers rows that are equal in key and source.

    docs holds the key columns, source and a non-negative size. Copies lie between 0 and `most`. Sources whose sizes are all
    zero have target 0 and give no copies. The sizes of the sources, one number each, go through the driver.
    """
    known = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("n"), F.count("*").alias("rows")).collect()
    spark = docs.sparkSession
    goal = targets([(r["source"], int(r["n"] or 0)) for r in known], weights, share, most)
    plan = spark.createDataFrame(
        [("n" if r["source"] is None else "s" + r["source"], int(r["n"] or 0), float(goal[r["source"]]), int(-(-r["rows"] // group_rows))) for r in known],
        "source_key string, source_size long, target double, groups long",
    )
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    names = [f"k{i}" for i in range(len(key))]
    slim = docs.select(*(F.col(f"`{name}`").alias(alias) for name, alias in zip(key, names, strict=True)), F.col(size).alias("size"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("source_key"))
    slim = slim.withColumn("order", F.xxhash64(F.lit(seed), *names, "size", "source_key"))
    equal = slim.groupBy("source_key", "size", "order", *names).agg(F.count("*").alias("_equal"))
    rows = equal.select("*", F.explode(F.sequence(F.lit(1), F.col("_equal").cast("int"))).alias("row")).drop("_equal")
    rows = rows.withColumn("order", F.xxhash64("order", "row")).withColumn("salt", F.pmod("order", F.lit(SALTS)).cast("int"))
    rows = rows.join(plan, ["source_key", "salt"]).drop("salt")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("sure", F.least(F.floor(rate), F.lit(most))).withColumn("chance", rate - F.col("sure"))
    rows = rows.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "order"), "groups")).drop("groups")
    left = max([1, *(-(-r["rows"] // group_rows) for r in known)])
    state, settled = stored(_flight(rows, "group", left == 1), "flight"), []
    while left > 1:
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled.append(state.where(~open_))
        left = -(-left // GROUP_FAN)
        state = stored(_flight(state.where(open_).withColumn("group", F.expr(f"`group` div {GROUP_FAN}")), "group", left == 1), "flight")
    for part in settled:
        state = state.unionByName(part)
    state = state.withColumn("copies", (F.col("sure") + F.col("chance")).cast("int"))
    return state.select(*(F.col(alias).alias(name) for name, alias in zip(key, names, strict=True)), "size", F.expr("if(source_key = 'n', null, substring(source_key, 2))").alias("source"), "source_size", "target", "row", "copies")


def words_of(text: str):
    """Number of words of a text column; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every document."""
    slim = docs.select("doc_id", "source", words_of("text").alias("size"))
    out = sampled(slim, "size", ["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs.

    Rows equal in doc_id, text and source are interchangeable: the copies drawn for them are dealt out evenly among them.
    """
    told = ["doc_id", "text", "source"]
    nulls = [F.col(name).isNull() for name in told]
    keyed = docs.select(F.struct("*").alias("_all"), F.xxhash64(*told, *nulls).alias("_key"), F.xxhash64(F.lit(1), *told, *nulls).alias("_key2"), "source", words_of("text").alias("_size"))
    drawn = sampled(keyed, "_size", ["_key", "_key2"]).groupBy("_key", "_key2").agg(F.sum("copies").alias("_sum"), F.count("*").alias("_of"))
    keys = ["_key", "_key2"]
    joined = keyed.select("_all", *keys).join(drawn.where("_sum > 0"), keys)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_sum"))
    joined = joined.withColumn("_n", F.expr("_sum div _of").cast("int") + (number <= F.col("_sum") % F.col("_of")).cast("int"))
    return joined.where("_n > 0").select("_all", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_all.*")
