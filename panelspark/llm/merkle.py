"""Merkle manifest of a table: a content-addressed graph, proofs by descent from the root, tamper checks.

Leaves are digests of rows, ordered by source and id. The rows of a source make a tree, the roots of the
sources another one above; a node is the digest of its children's hexadecimal digests. The store keeps
(level, digest, children), equal nodes once. Requests for leaves start at the root and go down by the
digits of their ranks, those with a common way as one row; the children they pass by are collected, and the
way is reversed at the end. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import common

#: Children of a node.
ARITY = 3
#: Levels built in one exchange: a group has at most ARITY ** LEVELS digests.
LEVELS = 6
#: Levels a descent goes down in one plan.
TOGETHER = 3
_WAY = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, put together."""
    return F.sha2(F.concat(*parts), 256)


def field(column: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_digest(columns: list[Column]) -> Column:
    return digest(*map(field, columns))


def _height(n: int) -> int:
    """Levels above n nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def _heights(n: Column) -> Column:
    """The same of a column: how many powers of ARITY are below n."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(39)]), lambda p: p < n)).cast("int")


def ordered_leaves(rows: DataFrame, source: str, key: str, leaf: str) -> DataFrame:
    """``rows`` (a staged table) with source number, rank within the source, and the source's count.

    One range exchange by (source, key, leaf); a task numbers its range, whichever sources are in it, so a
    source with most rows is spread over many tasks. What is joined has a row per source and task.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first(source), F.asc_nulls_first(key), F.asc(leaf)]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    dealt = common.stage(
        dealt.select("*", F.shiftright(at, 33).alias("part"), at.bitwiseAND(2**33 - 1).alias("place")), "leaves"
    )
    pieces = dealt.groupBy("part", source).agg(F.count(F.lit(1)).alias("own"), F.min("place").alias("first"))
    upto = Window.partitionBy(source).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("own").over(upto), F.lit(0)))
    pieces = pieces.withColumn("count", F.sum("own").over(Window.partitionBy(source)))
    numbers = ranks_of_sources(common.stage(pieces.groupBy(source).agg(F.max("count").alias("count")), "sources"), source)
    pieces = pieces.join(numbers.select(F.col(source).alias("_s"), "number"), F.col(source).eqNullSafe(F.col("_s"))).drop("_s")
    pieces = common.stage(pieces, "pieces")
    small = pieces.select(
        F.col("part").alias("_part"), F.col(source).alias("_source"), "number", "count", "before", "first"
    )
    joined = dealt.join(small, (dealt["part"] == small["_part"]) & dealt[source].eqNullSafe(small["_source"]))
    return joined.withColumn("rank", F.col("before") + F.col("place") - F.col("first")).drop(
        "_part", "_source", "before", "first", "part", "place"
    )


def ranks_of_sources(sources: DataFrame, source: str) -> DataFrame:
    """``number`` from 0 by source, NULL first, as UTF-8 bytes compare: a range exchange and a row per task."""
    from panelspark.llm.resampling import ranked

    return ranked(sources, [F.asc_nulls_first(source)], "number").withColumn("number", F.col("number") - 1)


def _parents(below: str) -> Column:
    """Digests of every ARITY neighbours of an array of digests."""
    runs = F.sequence(F.lit(0), F.expr(f"cast(ceil(size({below}) / {ARITY}) as int)") - 1)
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * ARITY + 1, ARITY), ""), 256))


def _records(level: int, name: str, below: str) -> Column:
    """(level, digest, children) of an array of digests over the one below it."""
    return F.transform(
        F.col(name),
        lambda d, i: F.struct(
            F.lit(level).alias("level"), d.alias("digest"), F.slice(below, i * ARITY + 1, ARITY).alias("children")
        ),
    )


def build(nodes: DataFrame, heights: list[int]) -> tuple[DataFrame, DataFrame]:
    """(store, roots) over ``nodes`` (tree, pos, digest, height): trees of the given heights, from their leaves.

    store: level, digest, children. roots: tree, digest, height. A round puts ARITY ** LEVELS neighbours
    into one group and hands one digest of each on; groups never grow, whatever a tree holds.
    """
    stores, roots, base = [], [], 0
    top = max(heights, default=0)
    while True:
        done = nodes.where(F.col("height") <= base)
        roots.append(done.select("tree", "digest", "height"))
        if base >= top:
            break
        group = nodes.where(F.col("height") > base).groupBy("tree", "height", F.expr(f"pos div {ARITY**LEVELS}").alias("pos"))
        level = group.agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("low"))
        level = level.withColumn("l0", F.col("low.digest")).drop("low")
        records = []
        for j in range(1, LEVELS + 1):
            below, name = f"l{j - 1}", f"l{j}"
            # above a tree's height its one digest is handed through
            built = F.col("height") >= base + j
            level = level.withColumn(name, F.when(built, _parents(below)).otherwise(F.col(below)))
            records.append(F.when(built, _records(base + j, name, below)).otherwise(F.array()))
        level = common.stage(level, "levels")
        found = level.select(F.explode(F.concat(*records)).alias("r")).select("r.*")
        stores.append(found)
        nodes = level.select("tree", "height", "pos", F.col(f"l{LEVELS}")[0].alias("digest"))
        base += LEVELS
    store = stores[0] if stores else None
    for s in stores[1:]:
        store = store.unionByName(s)
    found = roots[0]
    for r in roots[1:]:
        found = found.unionByName(r)
    return store, found


def descend(starts: DataFrame, store: DataFrame, top: int, stop: int = 0, wanted: DataFrame | None = None) -> DataFrame:
    """Requests (tree, height, pos, digest, way, and more) of ``starts`` at their height, down to level ``stop``.

    A request stands for all leaves below it, so a level has as many rows as it has nodes on some way;
    trees join in at their own height. Each level is one join by digest with the store; equal nodes are one
    record. ``wanted`` (tree, pos) are leaves; without it all are.
    """
    requests = starts.where(F.col("height") == top)
    for h in range(top, stop, -1):
        records = store.where(F.col("level") == h).groupBy("digest").agg(F.first("children").alias("children"))
        down = requests.join(records, "digest")
        down = down.select(*[c for c in requests.columns if c not in ("digest",)], "children", F.posexplode("children").alias("i", "digest"))
        passed = F.struct(
            F.array_join(F.slice("children", F.lit(1), F.col("i")), "").alias("left"),
            F.array_join(F.slice("children", F.col("i") + 2, F.lit(ARITY)), "").alias("right"),
        )
        down = down.withColumn("pos", F.col("pos") * ARITY + F.col("i")).withColumn(
            "way", F.concat("way", F.array(passed).cast(_WAY))
        )
        requests = down.select(*requests.columns)
        if wanted is not None:
            asked = wanted.select("tree", F.expr(f"pos div {ARITY ** (h - 1)}").alias("pos")).distinct()
            requests = requests.join(asked, ["tree", "pos"], "left_semi")
        requests = requests.unionByName(starts.where(F.col("height") == h - 1)) if h - 1 > 0 else requests
        if (top - h) % TOGETHER == TOGETHER - 1 and h - 1 > stop:
            requests = common.stage(requests, "requests")
    if stop == 0:
        requests = requests.unionByName(starts.where(F.col("height") == 0)) if top > 0 else starts
    return requests


def proof_digest(way: Column) -> Column:
    """Digest of all siblings, from the leaf up to the root, left to right."""
    return F.sha2(F.array_join(F.transform(way, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, way: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(way, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(
    rows: DataFrame, columns: list[str], *, source: str = "source", key: str = "doc_id", text: str = "text",
    tampered: Column | None = None,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``columns`` are digested. Where ``tampered`` holds, the leaf that is folded is that of the row without
    the \\n in ``text``; everything else stays. NULLs are digested as ``-``; rows with a NULL source are a source
    of their own, before the others; within a source NULL keys come first. Rows with equal keys are ordered by
    their leaves, repeated rows are neighbours with equal leaves and ways of their own. A source of one
    row has it as its subroot, a table of one source that one's subroot as its root; an empty table gives an empty
    result. Columns not named are ignored, so names can't clash. Rows are digested where they lie; only
    digests, keys and sources are exchanged.
    """
    cols = {c: F.col(c) for c in columns}
    bare = dict(cols)
    if tampered is not None:
        whole = F.col(text).cast("string")
        bare[text] = F.when(tampered, F.replace(whole, F.lit("\n"), F.lit(""))).otherwise(whole)
    leaves = common.stage(
        rows.select(
            F.col(source).cast("string").alias("source"), F.col(key).alias("key"),
            row_digest(list(cols.values())).alias("leaf"), row_digest(list(bare.values())).alias("other"),
        ).withColumn("other", F.when(F.col("other") != F.col("leaf"), F.col("other"))),
        "digests",
    )
    ordered = common.stage(ordered_leaves(leaves, "source", "key", "leaf"), "ordered")
    shape = ordered.agg(F.max("count").alias("most"), F.max("number").alias("last")).first()
    if shape["most"] is None:
        return leaves.select(
            F.col("key").alias(key), "leaf", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
            F.lit(True).alias("verified"),
        )
    low, high = _height(shape["most"]), _height(shape["last"] + 1)
    height = _heights(F.col("count"))
    nodes = ordered.select(F.col("number").alias("tree"), F.col("rank").alias("pos"), F.col("leaf").alias("digest"), height.alias("height"))
    store, roots = build(nodes, list(range(low + 1)))
    roots = common.stage(roots, "subroots")
    over = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(high).alias("height"))
    upper, root = build(over, [high])
    # from the root to the subroots, then on in each source's own tree
    start = root.select("tree", "height", F.lit(0).cast("long").alias("pos"), "digest", F.array().cast(_WAY).alias("way"))
    root = root.first()["digest"]
    found = descend(start, upper, high)
    subroots = roots.select(F.col("tree").alias("pos"), F.col("height").alias("own"))
    starts = found.join(subroots, "pos").select(
        F.col("pos").alias("tree"), F.col("own").alias("height"), F.lit(0).cast("long").alias("pos"), "digest", "way",
        F.col("digest").alias("subroot"),
    )
    starts = common.stage(starts, "starts")
    # leaves meet their ways one level up, so that a way is exchanged once for its ARITY leaves
    ways = descend(starts, store, low, 1) if low else starts
    asked = ordered.select(
        F.col("number").alias("tree"), F.expr(f"rank div {ARITY}").alias("pos"), "key", "leaf", "other",
        F.col("rank").alias("rank"), "count",
    )
    if low:
        records = store.where("level = 1").groupBy("digest").agg(F.first("children").alias("children"))
        ways = ways.join(records, "digest").select("tree", "pos", "way", "subroot", "children").unionByName(
            starts.where("height = 0").select("tree", "pos", "way", "subroot", F.array("digest").alias("children"))
        )
    else:
        ways = ways.select("tree", "pos", "way", "subroot", F.array("digest").alias("children"))
    joined = ways.join(asked, ["tree", "pos"])
    i = F.expr(f"cast(rank % {ARITY} as int)")
    last = F.struct(
        F.array_join(F.slice("children", F.lit(1), i), "").alias("left"),
        F.array_join(F.slice("children", i + 2, F.lit(ARITY)), "").alias("right"),
    )
    way = F.when(F.col("count") > 1, F.concat("way", F.array(last).cast(_WAY))).otherwise(F.col("way"))
    joined = joined.withColumn("way", F.reverse(way))
    joined = joined.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("way")))
    return joined.select(
        F.col("key").alias(key), "leaf", "subroot", F.lit(root).alias("root"), proof_digest(F.col("way")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
