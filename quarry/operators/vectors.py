"""Update-vector analytics over tensor chunks, all in double precision.

Tensor rows look like the ``tensor`` view: (party, k, name, vals array<float>)
where ``k`` is a chunk key and ``name`` the tensor it belongs to. Chunks are
joined by key (a hash join on k spreads evenly; no chunk is ever collected to
the driver). Per-chunk arithmetic is ``zip_with``/``aggregate`` inside the JVM;
the Gram matrix multiplies blocks of parties in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import layer_of
from quarry.operators.ordering import first_n
from quarry.session import shuffle_partitions

ALIGNED, OPPOSED = 0.1, -0.1


def as_double(vals: Column) -> Column:
    return vals.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Sequential sum of a[i] * b[i] (left fold, same order as any engine's fold)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sub(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def with_base(t: DataFrame, base_party: int = 0, key: str = "k") -> DataFrame:
    """Non-base chunks inner-joined to the base chunk with the same key,
    ``delta = vals - base`` (only when the shapes agree)."""
    base = t.filter(F.col("party") == base_party).select(key, F.col("name").alias("base_name"),
                                                        as_double(F.col("vals")).alias("base"))
    other = t.filter(F.col("party") != base_party).withColumn("vals", as_double(F.col("vals")))
    j = other.join(base, key)
    same = F.size("vals") == F.size("base")
    return j.withColumn("shape_ok", same).withColumn(
        "delta", F.when(same, sub(F.col("vals"), F.col("base"))))


def update_norms(wb: DataFrame) -> DataFrame:
    """V2: per party, squared delta norm over common keys, and the count of keys."""
    return wb.filter("shape_ok").groupBy("party").agg(
        F.sum(dot(F.col("delta"), F.col("delta"))).alias("norm2"), F.count(F.lit(1)).alias("n_keys"))


def common_keys(t: DataFrame, key: str = "k") -> DataFrame:
    """Keys present for every party."""
    n = t.select("party").distinct().agg(F.count(F.lit(1)).alias("_n"))
    per = t.groupBy(key).agg(F.countDistinct("party").alias("_c"))
    return per.join(F.broadcast(n), per["_c"] == n["_n"]).select(key)


def key_difference(t: DataFrame, base_party: int = 0, key: str = "k") -> DataFrame:
    """Per party, keys only in the base and keys only in the party (counts).

    ``only_base = |base| - shared``; nothing is paired.
    """
    base = t.filter(F.col("party") == base_party).select(key).distinct()
    have = t.filter(F.col("party") != base_party).select("party", key).distinct()
    tagged = have.join(base.withColumn("_in_base", F.lit(True)), key, "left")
    g = tagged.groupBy("party").agg(F.count(F.when(F.col("_in_base"), 1)).alias("shared"),
                                    F.count(F.when(F.col("_in_base").isNull(), 1)).alias("only_other"))
    # One extra row carries |base|; a window over this tiny table spreads it.
    nb = base.agg(F.lit(-1).alias("party"), F.count(F.lit(1)).alias("shared"), F.lit(0).cast("long").alias("only_other"))
    g = g.unionByName(nb).withColumn("_nb", F.max(F.when(F.col("party") == -1, F.col("shared"))).over(Window.partitionBy()))
    return g.filter(F.col("party") != -1).select(
        "party", "shared", (F.col("_nb") - F.col("shared")).alias("only_base"), "only_other")


# Parties of a block: a task holds the vectors of two blocks for one chunk key at a time.
PARTY_BLOCK = 32


def _block_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of delta products of (task, bi, bj, k, b, party, delta) rows sorted by (task, k): one row a pair of parties and task."""
    held: list[tuple[int, int, int, np.ndarray]] = []  # the open key: (bi, b, party, delta)
    sums: dict[tuple[int, int], float] = {}
    task = key = None

    def close_key() -> None:
        if not held:
            return
        bi = held[0][0]
        left = [(p, v) for _, b, p, v in held if b == bi]
        right = [(p, v) for _, b, p, v in held if b != bi] or left
        g = np.stack([v for _, v in left]) @ np.stack([v for _, v in right]).T
        for x, (i, _) in enumerate(left):
            for y, (j, _) in enumerate(right):
                if i <= j:
                    sums[i, j] = sums.get((i, j), 0.0) + float(g[x, y])
        held.clear()

    def close_task() -> pa.RecordBatch:
        rows = [(i, j, d) for (i, j), d in sums.items()]
        sums.clear()
        cols = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.float64()), strict=True)], names=["i", "j", "d"])

    for batch in batches:
        tasks, bis, bjs, ks, bs, parties = (batch.column(c).to_pylist() for c in ("task", "bi", "bj", "_k", "b", "party"))
        lists = batch.column("delta")
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        for r in range(batch.num_rows):
            if (tasks[r], ks[r]) != (task, key):
                close_key()
                if task is not None and tasks[r] != task:
                    yield close_task()
                task, key = tasks[r], ks[r]
            if bis[r] == bjs[r] or bs[r] in (bis[r], bjs[r]):
                held.append((bis[r], bs[r], parties[r], values[ends[r]:ends[r + 1]].copy()))
    close_key()
    yield close_task()


def pair_keys(t: DataFrame, base_party: int = 0, key: str = "k") -> DataFrame:
    """Pairs i <= j of parties beside the base and the keys common to all; no vector is read."""
    others = t.filter(F.col("party") != base_party).agg(F.array_sort(F.collect_set("party")).alias("ps"))  # one entry a party
    both = others.withColumn("n", F.lit(None).cast("long")).unionByName(
        common_keys(t, key).agg(F.count(F.lit(1)).alias("n")).withColumn("ps", F.lit(None).cast(others.schema["ps"].dataType)))
    one = both.agg(F.max("ps").alias("ps"), F.max("n").alias("n_keys")).filter("n_keys > 0")
    left = one.select("ps", "n_keys", F.posexplode("ps").alias("at", "i"))
    return left.select("i", F.explode(F.slice("ps", F.col("at") + 1, F.size("ps"))).alias("j"), "n_keys")


def gram(t: DataFrame, base_party: int = 0, key: str = "k", block: int = PARTY_BLOCK) -> DataFrame:
    """V4: Gram matrix of update vectors (party - base) over keys common to all.

    Deltas are made once, against the base joined by key. Parties are cut into
    blocks; a task takes a range of keys and a pair of blocks, multiplies the two
    blocks' deltas key by key and adds the products up, so a vector is sent once
    a block, no row holds all parties, and only sums leave a task. Norms are
    ``sqrt(max(0, G_ii))``, ``rel = norm / ||base||``, cosine is NaN when a norm is 0.
    """
    n = shuffle_partitions(t.sparkSession)
    rows = t.join(common_keys(t, key), key, "left_semi")
    parties = rows.filter(F.col("party") != base_party).select("party").distinct()
    parties = parties.withColumn("b", F.floor((F.row_number().over(Window.orderBy("party")) - 1) / block).cast("int"))
    parties = parties.withColumn("nb", F.max("b").over(Window.partitionBy()) + 1)  # one row a party
    d = with_base(rows, base_party, key).filter("shape_ok").select(F.col(key).alias("_k"), "party", "delta").join(parties, "party")
    d = d.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    d = d.select(F.least("b", "_o").alias("bi"), F.greatest("b", "_o").alias("bj"), "_k", "b", F.col("party").cast("int").alias("party"), "delta")
    d = d.withColumn("task", F.xxhash64(F.pmod(F.xxhash64("_k"), F.lit(n)), "bi", "bj"))
    laid = d.select("task", "bi", "bj", "_k", "b", "party", "delta").repartition(n, "task").sortWithinPartitions("task", "_k", "b", "party")
    cells = laid.mapInArrow(_block_products, "i int, j int, d double").groupBy("i", "j").agg(F.sum("d").alias("dot"))
    base = rows.filter(F.col("party") == base_party).select(as_double(F.col("vals")).alias("v"))
    base = base.agg(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.sum(dot(F.col("v"), F.col("v"))).alias("dot"), F.count(F.lit(1)).alias("n_keys"))
    g = cells.withColumn("n_keys", F.lit(None).cast("long")).unionByName(base)
    g = g.withColumn("n_keys", F.max("n_keys").over(Window.partitionBy()))
    # g has n(n+1)/2 + 1 rows: windows over it are free.
    every = Window.partitionBy()
    diag = F.when(F.col("i") == F.col("j"), F.sqrt(F.greatest(F.lit(0.0), F.col("dot"))))
    g = (g.withColumn("base_norm", F.sqrt(F.max(F.when(F.col("i") == -1, F.col("dot"))).over(every)))
          .withColumn("norm_i", F.max(diag).over(Window.partitionBy("i")))
          .withColumn("norm_j", F.max(diag).over(Window.partitionBy("j")))
          .filter(F.col("i") >= 0))
    cos = F.when((F.col("norm_i") > 0) & (F.col("norm_j") > 0),
                 F.col("dot") / (F.col("norm_i") * F.col("norm_j"))).otherwise(F.lit(float("nan")))
    return g.select("i", "j", "dot", "norm_i", "norm_j", (F.col("norm_i") / F.col("base_norm")).alias("rel_i"),
                    cos.alias("cosine"), "base_norm", "n_keys")


def pair_cosine(wb: DataFrame, a: int, b: int, key: str = "k") -> DataFrame:
    """V3: cosine between the deltas of parties a and b on shared keys; NULL if a norm is 0."""
    da = wb.filter((F.col("party") == a) & F.col("shape_ok")).select(key, F.col("delta").alias("da"))
    db = wb.filter((F.col("party") == b) & F.col("shape_ok")).select(key, F.col("delta").alias("db"))
    s = da.join(db, key).agg(F.sum(dot(F.col("da"), F.col("db"))).alias("dot"),
                              F.sum(dot(F.col("da"), F.col("da"))).alias("a2"),
                              F.sum(dot(F.col("db"), F.col("db"))).alias("b2"))
    return s.select(F.lit(a).alias("a"), F.lit(b).alias("b"), "dot",
                    F.try_divide(F.col("dot"), F.sqrt("a2") * F.sqrt("b2")).alias("cosine"))


def distance(wb: DataFrame, tensor: str = "name") -> DataFrame:
    """V5-V7: per party vs base over shared keys: identical tensors, tensors with a
    shape mismatch in any chunk (left out whole), relative L2, cosine of raw weights
    and the largest per-tensor relative change (first tensor name on ties)."""
    part = lambda x, y: F.sum(F.when(F.col("shape_ok"), dot(F.col(x), F.col(y))))
    every = wb.groupBy("party", tensor).agg(
        F.bool_and("shape_ok").alias("_ok"), part("delta", "delta").alias("sq"), part("base", "base").alias("rn"),
        part("base", "vals").alias("ab"), part("vals", "vals").alias("bb"),
        F.bool_and(F.col("vals") == F.col("base")).alias("same"))
    per_t = every.filter("_ok")
    per_t = per_t.withColumn("rel", F.when(F.col("rn") > 0, F.sqrt(F.col("sq") / F.col("rn"))).otherwise(F.lit(0.0)))
    top = first_n(per_t, ["party"], [F.col("rel").desc(), F.col(tensor)], 1).select(
        "party", F.col("rel").alias("max_rel"), F.col(tensor).alias("max_rel_tensor"))
    tot = per_t.groupBy("party").agg(
        F.count(F.when(F.col("same"), 1)).alias("identical"), F.count(F.lit(1)).alias("tensors"),
        F.sum("sq").alias("sq"), F.sum("rn").alias("rn"), F.sum("ab").alias("ab"), F.sum("bb").alias("bb"))
    mism = every.groupBy("party").agg(F.count(F.when(~F.col("_ok"), 1)).alias("shape_mismatch"))
    nan = F.lit(float("nan"))
    return (tot.join(mism, "party").join(top, "party", "left")
            .select("party", "tensors", "identical", "shape_mismatch",
                    F.when(F.col("rn") > 0, F.sqrt(F.col("sq") / F.col("rn"))).otherwise(nan).alias("rel_l2"),
                    F.when((F.col("rn") > 0) & (F.col("bb") > 0), F.col("ab") / (F.sqrt("rn") * F.sqrt("bb")))
                     .otherwise(nan).alias("cosine"),
                    "max_rel", "max_rel_tensor"))


def layer_stats(wb: DataFrame, ours: int, key: str = "k") -> DataFrame:
    """V8: per (rival, layer): rival and own squared delta norms, dot, cosine.

    Own deltas are joined to every rival's on the chunk key (the own side is one
    party, so each rival chunk meets at most one own chunk).
    """
    mine = wb.filter((F.col("party") == ours) & F.col("shape_ok")).select(key, F.col("delta").alias("od"))
    riv = wb.filter((F.col("party") != ours) & F.col("shape_ok")).withColumn("layer", layer_of("name"))
    j = riv.join(mine, key, "left")
    g = j.groupBy("party", "layer").agg(
        F.sum(dot(F.col("delta"), F.col("delta"))).alias("t2"),
        F.sum(F.when(F.col("od").isNotNull(), dot(F.col("od"), F.col("od")))).alias("o2"),
        F.sum(F.when(F.col("od").isNotNull(), dot(F.col("delta"), F.col("od")))).alias("ldot"),
        F.count(F.when(dot(F.col("delta"), F.col("delta")) > 0, 1)).alias("changed"),
        F.count(F.lit(1)).alias("chunks"))
    cos = F.when((F.col("t2") > 0) & (F.col("o2") > 0), F.col("ldot") / (F.sqrt("t2") * F.sqrt("o2")))
    w = Window.partitionBy("party").orderBy(F.col("t2").desc(), F.col("layer"))
    return g.withColumn("layer_cos", cos).withColumn("by_magnitude", F.row_number().over(w).cast("long"))


def layer_summary(ls: DataFrame) -> DataFrame:
    """V9: per rival: changed/total chunks, aligned (> 0.1) and opposed (< -0.1) layers, range."""
    return ls.groupBy("party").agg(
        F.sum("changed").alias("n_changed"), F.sum("chunks").alias("n_chunks"),
        F.count(F.when(F.col("layer_cos") > ALIGNED, 1)).alias("aligned"),
        F.count(F.when(F.col("layer_cos") < OPPOSED, 1)).alias("opposed"),
        F.count("layer_cos").alias("layers_with_cos"),
        F.min("layer_cos").alias("cos_min"), F.max("layer_cos").alias("cos_max"))


def top_layers(ls: DataFrame, k: int = 6) -> DataFrame:
    """Top-k layers per rival by share of the squared delta norm."""
    tot = ls.groupBy("party").agg(F.sum("t2").alias("_tot"))
    s = ls.join(tot, "party").withColumn("share", F.col("t2") / F.when(F.col("_tot") > 0, F.col("_tot")).otherwise(1.0))
    return first_n(s, ["party"], [F.col("t2").desc(), F.col("layer")], k, "place").select(
        "party", "layer", "share", F.col("place").cast("long").alias("place"))


def element_counts(t: DataFrame, dtype: Column, trainable: Column, shape: Column) -> DataFrame:
    """Elements by dtype (product of the shape) and the trainable share."""
    n = F.aggregate(shape, F.lit(1).cast("long"), lambda acc, x: acc * x)
    e = t.select("party", dtype.alias("dtype"), n.alias("n"), trainable.alias("tr"))
    g = e.groupBy("party", "dtype").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("elements"),
                                        F.sum(F.when(F.col("tr"), F.col("n")).otherwise(0)).alias("trainable"))
    return g.withColumn("trainable_share", F.col("trainable") / F.col("elements"))
