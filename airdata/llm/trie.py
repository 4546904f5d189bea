"""Conversations that share beginnings, as a prefix trie with rolled-up totals.

A node is a distinct sequence of first turns. It is named by the smallest
conversation that begins with it and by its depth, a pair that no other node
has. Sequences are never put together: a running exclusive-or of hashes of
(place, turn), two of 64 bits, tells the beginnings of a conversation apart, and
the running sums go over ranges, so a conversation of any length is dealt over
many tasks.

Totals of subtrees come from a centroid decomposition of the parent edges. The
weight of a subtree, its conversation turns, is known beforehand: a turn at depth
d of a conversation of length l adds l - d + 1 to its node. In every component
the deepest node that holds half of the weight is the centroid. The total of what
lies below it in the component is its own, and is added to the nodes on the path
from it to the top of the component; the path is read off one conversation
through the centroid. Then the component falls apart into the parts below the
centroid and the one above. Components halve, so the number of rounds grows with
the logarithm of the rows and not with the depth. Components above BLOCK nodes
are split as tables, smaller ones inside a task, by the same steps.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airdata.llm.common import groups, heavy_join, ship, staged
from airdata.operators.scan import ranges_of, running

#: Nodes of a component that one task splits by itself.
BLOCK = 512
#: Conversations whose numbers are put together before they are hashed.
ENDS = 512
#: Turns a conversation may take over from its base, and the size of a family of conversations.
HEADS, FAMILY = 4, 20
WORD = r"[^\x20\x09-\x0D]+"
#: What the roll-up sums.
VALUES = ("n_leaves", "saved_tokens")


def _xor(column: Column):
    return column, F.bit_xor, lambda a, b: a.bitwiseXOR(b)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), a, b (hashes of role and text) and words of every turn.

    Turns are ordered by ``turn``, null first; equal ones by role, then by hash.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), role, text).alias("b"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    one = (F.lit(1).cast("long"), F.sum, lambda a, b: a + b)
    return running(staged(slim, "turns"), ["conv_id"], ["turn", "role", "a", "b"], {"pos": one}).select("conv_id", "pos", "a", "b", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, length) and their turns (conv_id, length, depth, a, b, words).

    Conversation c takes over the first h turns of conversation c - c % FAMILY,
    h = crc32 of its decimal number modulo HEADS, then has its own after its
    first h.
    """
    own = staged(turns_of(conversations), "own")
    first = own.filter(F.col("pos") < HEADS).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head"))
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = sizes.select("conv_id", "n", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,words:bigint>>")), F.lit(1), F.col("h"))
    convs = convs.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "n", "h", head.alias("head"))
    length = F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = staged(convs.withColumn("length", length.cast("long")), "conversations")
    taken = convs.select("conv_id", "length", F.posexplode("head").alias("i", "t"))
    taken = taken.select("conv_id", "length", (F.col("i") + 1).cast("long").alias("depth"), "t.a", "t.b", "t.words")
    rest = heavy_join(own, convs.select("conv_id", "length", "n", "h", F.size("head").alias("k")), ["conv_id"], "n").filter("pos > h")
    rest = rest.select("conv_id", "length", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "a", "b", "words")
    return convs.select("conv_id", "length"), staged(taken.unionByName(rest), "rebuilt")


def trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes and the places of the rebuilt conversations.

    nodes: conv_id, depth, parent_conv_id, n_convs, n_children, weight, and the VALUES of
    the node by itself. places: conv_id, length, depth, node (the conv_id of its node there).
    """
    convs, turns = rebuilt(conversations)
    mine = [F.xxhash64("depth", "a", "b"), F.xxhash64(F.lit(1), "depth", "a", "b")]
    rows = turns.withColumns({"ha": mine[0], "hb": mine[1]})
    rows = staged(running(rows, ["conv_id"], ["depth"], {"xa": _xor(F.col("ha")), "xb": _xor(F.col("hb"))})
                  .select("conv_id", "length", "depth", "words", "xa", "xb"), "beginnings")
    named = staged(rows.groupBy("depth", "xa", "xb").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("node"), F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "nodes")
    places = heavy_join(rows.select("conv_id", "length", "depth", "xa", "xb"), named.select("depth", "xa", "xb", "node", "n_convs"), ["depth", "xa", "xb"], "n_convs")
    top = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("weight"))
    at_root = convs.select("conv_id", "length", top.alias("depth"), root.select("node").scalar().alias("node"))
    places = staged(places.select("conv_id", "length", "depth", "node").unionByName(at_root), "places")

    inner = named.select(F.col("node").alias("conv_id"), "depth", "n_convs", "words", "weight")
    inner = inner.unionByName(root.filter("n_convs > 0").select(F.col("node").alias("conv_id"), top.alias("depth"), "n_convs", top.alias("words"), "weight"))
    # the beginning one turn shorter of the conversation that names the node: a key is asked for once
    above = places.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    edges = staged(inner.join(above, ["conv_id", "depth"], "left")
                   .withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id"))), "edges")
    children = edges.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = edges.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = (nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
             .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")).drop("words"))
    return staged(nodes, "trie"), places


def split(parent: list[int], weight: list[int], values: list[tuple]) -> list[list[int]]:
    """Subtree sums of one component, by centroid decomposition.

    Nodes come in the order of their depth, the top first; ``parent`` has their
    places (the top's is not looked at), ``weight`` strictly falls from a node to
    its children.
    """
    w, out, waiting = list(weight), [[0] * len(v) for v in values], [list(range(len(parent)))]

    def add(node, total):
        out[node] = [x + y for x, y in zip(out[node], total)]

    while waiting:
        part = waiting.pop()
        top = part[0]
        if len(part) == 1:
            add(top, values[top])
            continue
        c = min((v for v in part if 2 * w[v] >= w[top]), key=w.__getitem__)
        side, below, above, total = {c: c}, {}, [], values[c]
        for v in part:
            if v == c:
                continue
            at = side.get(parent[v]) if v != top else None
            if at is None:
                above.append(v)
                continue
            side[v] = v if at == c else at
            below.setdefault(side[v], []).append(v)
            total = [x + y for x, y in zip(total, values[v])]
        add(c, total)
        v = c
        while v != top:
            v = parent[v]
            add(v, total)
            w[v] -= w[c]
        waiting.extend(below.values())
        if above:
            waiting.append(above)
    return out


def _rolled_inside(tree: DataFrame, values: tuple) -> DataFrame:
    """Sums of the subtrees of components that fit in a task."""
    ship(tree.sparkSession)

    def run(batches):
        for g in groups(batches, "top", "top_depth"):
            conv, depth, up, weight, *of = (g.column(c).to_pylist() for c in ("conv_id", "depth", "parent_conv_id", "weight", *values))
            place = {n: i for i, n in enumerate(zip(conv, depth))}
            sums = split([place.get((p, d - 1), -1) for p, d in zip(up, depth)], weight, list(zip(*of)))
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*sums))], ["conv_id", "depth", *values])

    dealt = tree.repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", "depth")
    return dealt.select("top", "top_depth", "conv_id", "depth", "parent_conv_id", "weight", *values).mapInArrow(
        run, "conv_id long, depth long, " + ", ".join(f"{v} long" for v in values))


def rollup(nodes: DataFrame, places: DataFrame, values: tuple = VALUES, block: int = BLOCK) -> DataFrame:
    """conv_id, depth and the sums of ``values`` over the subtree of every node of a trie."""
    top = ["top", "top_depth"]
    root = nodes.filter("depth = 0").select("conv_id").scalar()
    tree = nodes.select("conv_id", "depth", "parent_conv_id", "weight", *values, root.alias("top"), F.lit(0).cast("long").alias("top_depth"))
    steps = places.select("conv_id", "depth", "node")
    after = steps.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("node").alias("child"))
    small, sums = [], []
    while True:
        sizes = staged(tree.groupBy(*top).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total")), "components")
        if sizes.filter(F.col("n") > block).isEmpty():
            small.append(tree)
            break
        sized = heavy_join(tree, sizes, top, "n")
        small.append(staged(sized.filter(F.col("n") <= block).drop("n", "total"), "small"))
        large = staged(sized.filter(F.col("n") > block), "large")
        # weights fall from a node to its children, so the least that holds half is one node
        centroid = large.filter("2 * weight >= total").groupBy(*top).agg(
            F.min_by(F.struct("conv_id", "depth", "weight"), "weight").alias("c"), F.max("n").alias("n"))
        centroid = staged(centroid.select(*top, "n", F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")), "centroids")
        met = staged(heavy_join(large.drop("n", "total"), centroid, top, "n").drop("n"), "met")
        # nodes named by one conversation lie on one path: it is looked up once whether that runs through the centroid
        paths = met.filter("depth > c_depth").groupBy(*top, "conv_id", "c_conv", "c_depth").agg(F.count(F.lit(1)).alias("m"))
        through = (paths.join(steps.withColumnRenamed("depth", "c_depth"), ["conv_id", "c_depth"]).filter("node = c_conv")
                   .join(after.withColumnRenamed("depth", "c_depth"), ["conv_id", "c_depth"]).select(*top, "conv_id", "child", "m"))
        told = heavy_join(met, staged(through, "through"), [*top, "conv_id"], "m", "left")
        below = F.col("child").isNotNull() & (F.col("depth") > F.col("c_depth"))
        is_centroid = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        told = staged(told.withColumns({"below": below, "is_centroid": is_centroid}).drop("m"), "told")
        total = told.filter("below or is_centroid").groupBy(*top).agg(*[F.sum(v).alias(v) for v in values])
        total = staged(centroid.join(total, top), "totals")
        # the centroid and the path from it to the top of its component
        path = total.select("c_conv", "c_weight", "c_depth", *values, F.explode(F.sequence("top_depth", "c_depth")).alias("depth"))
        path = path.join(steps.withColumnRenamed("conv_id", "c_conv"), ["c_conv", "depth"])
        path = staged(path.select(F.col("node").alias("conv_id"), "depth", *values, F.when(F.col("depth") < F.col("c_depth"), F.col("c_weight")).otherwise(F.lit(0)).alias("off")), "paths")
        sums.append(path.select("conv_id", "depth", *values))
        left = told.filter("not is_centroid").join(path.select("conv_id", "depth", "off"), ["conv_id", "depth"], "left")
        tree = staged(left.select("conv_id", "depth", "parent_conv_id", (F.col("weight") - F.coalesce("off", F.lit(0))).alias("weight"), *values,
                                  F.when(F.col("below"), F.col("child")).otherwise(F.col("top")).alias("top"),
                                  F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth")), "tree")
    all_small = small[0]
    for s in small[1:]:
        all_small = all_small.unionByName(s)
    out = _rolled_inside(all_small, values)
    for s in sums:
        out = out.unionByName(s)
    return out.groupBy("conv_id", "depth").agg(*[F.sum(v).alias(v) for v in values])


def ends(places: DataFrame) -> DataFrame:
    """conv_id, depth and ends_sha256 of the nodes where conversations end.

    The numbers of the conversations are put in order over the cluster and
    written out in blocks; the hash of a node, which can only go from its first
    byte to its last, then reads blocks, and holds none of them.
    """
    ship(places.sparkSession)
    last = places.filter("depth = length").select("node", "depth", "conv_id")
    order = ["node", "depth", "conv_id"]

    def blocks(batches):
        for b in batches:
            node, depth, conv = (b.column(c).to_pylist() for c in order)
            cut = [0, *(i for i in range(1, len(node)) if (node[i], depth[i]) != (node[i - 1], depth[i - 1])), len(node)]
            cut = [k for i, j in zip(cut, cut[1:]) for k in range(i, j, ENDS)]
            text = [",".join(map(str, conv[i:j])) for i, j in zip(cut, [*cut[1:], len(node)])]
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in cut], pa.int64()) for c in (node, depth, conv)] + [pa.array(text, pa.string())], [*order, "text"])

    def hashed(batches):
        now, state = None, None
        for b in batches:
            out = []
            for node, depth, text in zip(*(b.column(c).to_pylist() for c in ("node", "depth", "text"))):
                if (node, depth) == now:
                    state.update(b",")
                else:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = (node, depth), hashlib.sha256()
                state.update(text.encode())
            yield _ended(out)
        if now:
            yield _ended([(*now, state.hexdigest())])

    ranged = last.repartitionByRange(ranges_of(places), *order).sortWithinPartitions(*order)
    text = ranged.mapInArrow(blocks, "node long, depth long, conv_id long, text string")
    return text.repartition("node", "depth").sortWithinPartitions(*order).mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")


def _ended(rows: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["conv_id", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations.

    ``conversations``: conv_id, turn, role, text; other columns play no part,
    whatever their names. Returns conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Rows without a conv_id take no part; a null role or
    text is empty; a null turn comes first, equal turns are ordered by role and
    hash, and repeated rows are turns of their own. Texts and conversations may
    be of any length. An empty table gives no rows.
    """
    nodes, places = trie(conversations)
    totals = rollup(nodes, places, block=block)
    out = nodes.drop("weight", *VALUES).join(totals, ["conv_id", "depth"]).join(ends(places), ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *VALUES,
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
