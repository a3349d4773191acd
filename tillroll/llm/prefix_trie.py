"""The trie of conversation prefixes by ROLLUP over turn columns.

A conversation's turns stand in blocks of `BLOCK` columns. One ROLLUP over the columns
of all blocks aggregates every prefix, and grouping_id says which. A block is keyed by
the node that the blocks before it lead to. That node's name is a digest of the block
sequence, which is found level by level (blocks of blocks of blocks), so a conversation
of n turns takes log(n) rounds and not n / `BLOCK`.

Subtrees take no walk over the trie either. Each node belongs to its smallest member,
and a conversation owns its nodes from some depth on. The subtree of a node holds
exactly what its members own from that depth on, so every subtree figure is a plain
sum over members: a second ROLLUP over the same columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import crc_fold, staged
from tillroll.llm.numbering import numbered

BLOCK = 8  # turn columns of a block
CHUNK = 4_096  # consecutive identifiers that a row of endings may hold
RUN = 1_024  # blocks of a long conversation that are summed up first
ROOT = b""  # the root's name

_PLACES = range(1, BLOCK + 1)


def _digest(value: Column) -> Column:
    """128 bits of SHA-256: equal only for equal values, for all that a cluster can hold."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """`conv_id, place, said, length`: the turns in order, from place 1, by what they say.

    `said` stands for role and text, null taken as empty; `length` counts the text's
    code points. Null turn numbers come first; rows of one turn number are ordered by
    `said`, and repeated rows all count. Rows without conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), F.length(text).cast("long").alias("length")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("said").asc()]
    placed = numbered(staged(rows, "trie-turns"), "conv_id", order, "place", "trie-sorted")
    return placed.select("conv_id", (F.col("place") + 1).alias("place"), "said", "length")


def share_openings(turns: DataFrame, group: int = 100, folds: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of their group's first one, and their sizes.

    Conversation c becomes the first h turns of conversation c - c % `group`, as far as
    there are any, and its own turns after its first h, h = crc32(c) % `folds`.
    `turns` is what `ordered_turns` returns. Returns `conv_id, place, said, length,
    n_turns` of each turn and `conv_id, n_turns` of each conversation, also turnless ones.
    """
    own = staged(turns, "trie-own")
    sizes = staged(own.groupBy("conv_id").agg(F.count("*").alias("n_own")), "trie-sizes")
    first = F.col("conv_id") - F.col("conv_id") % group
    openings = sizes.select(F.col("conv_id").alias("first"), F.col("n_own").alias("n_first"))
    plan = sizes.select("*", first.alias("first"), crc_fold(F.col("conv_id"), folds).alias("h"))
    plan = plan.join(openings, "first", "left").withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0))))
    plan = plan.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    plan = staged(plan.select("conv_id", "first", "h", "taken", "n_turns"), "trie-plan")
    opened = own.filter(F.col("place") < folds).withColumnRenamed("conv_id", "first")
    opened = opened.join(plan, "first").filter("place <= h")
    rest = own.join(plan, "conv_id").filter("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    kept = ["conv_id", "place", "said", "length", "n_turns"]
    return opened.select(kept).unionByName(rest.select(kept)), plan.select("conv_id", "n_turns")


def _chain(name: Column, items: Column, n: Column) -> Column:
    """The name of the node that `items[:n]` lead to from the node `name`."""
    return F.aggregate(F.slice(items, 1, n), name, lambda before, item: _digest(F.concat(before, item)))


def _names_before(items: DataFrame, most: int) -> DataFrame:
    """`conv_id, at, parent`: a name for all items before each item, equal only for equal ones.

    `items` has `conv_id, at, item`, at from 0 to `most` - 1 at most. Groups of items
    are named first, as items of their own, one level up.
    """
    groups = items.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("section")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("items")
    )
    if most <= BLOCK:
        named = groups.withColumn("prior", F.lit(ROOT))
    else:
        groups = staged(groups, "trie-sections")
        upper = groups.select("conv_id", F.col("section").alias("at"), _digest(F.array_join(F.transform("items", F.hex), "")).alias("item"))
        prior = _names_before(upper, -(-most // BLOCK)).withColumnsRenamed({"at": "section", "parent": "prior"})
        named = groups.join(prior, ["conv_id", "section"])
    each = F.posexplode(F.transform("items", lambda _, i: _chain(F.col("prior"), F.col("items"), i)))
    names = named.select("conv_id", "section", each.alias("i", "parent"))
    return staged(names.select("conv_id", (F.col("section") * BLOCK + F.col("i")).alias("at"), "parent"), "trie-names")


def _blocks(turns: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """One row per conversation and block: its key, its turns in columns of `BLOCK` places."""
    grouped = turns.groupBy("conv_id", F.floor((F.col("place") - 1) / BLOCK).alias("block")).agg(
        F.max("n_turns").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("place", "said", "length"))).alias("turns"),
    )
    rows = grouped.select(
        "conv_id", "block", "n_turns", F.col("turns.said").alias("said"), F.col("turns.length").alias("length")
    )
    if most <= BLOCK:
        rows = rows.withColumn("parent", F.lit(ROOT))
    else:
        rows = staged(rows, "trie-blocks")
        long = rows.filter(F.col("n_turns") > BLOCK)
        items = long.select("conv_id", F.col("block").alias("at"), _digest(F.array_join(F.transform("said", F.hex), "")).alias("item"))
        later = _names_before(items, -(-most // BLOCK)).filter("at > 0").withColumnRenamed("at", "block")
        rows = rows.join(later, ["conv_id", "block"], "left").withColumn("parent", F.coalesce("parent", F.lit(ROOT)))
    turnless = sizes.filter("n_turns = 0").select(
        "conv_id",
        F.lit(0).cast("long").alias("block"),
        "n_turns",
        F.array().cast("array<binary>").alias("said"),
        F.array().cast("array<bigint>").alias("length"),
        F.lit(ROOT).alias("parent"),
    )
    return staged(rows.unionByName(turnless), "trie-rows")


def _rollup(rows: DataFrame, by_place: dict[str, str], plain: dict[str, str]) -> DataFrame:
    """All prefixes of all blocks at once: `conv_id, depth, name`, and the aggregates.

    `by_place` gives an aggregate of each place from 0 to BLOCK (`{d}` in its text), of
    which a prefix of d turns in this block takes that of d; `plain` is the same for all.
    """
    turns = ", ".join(f"t{d}" for d in _PLACES)
    columns = ", ".join(f"get(said, {d - 1}) AS t{d}" for d in _PLACES)
    each = ", ".join(f"array({', '.join(sql.format(d=d) for d in range(BLOCK + 1))}) AS {n}" for n, sql in by_place.items())
    other = ", ".join(f"{sql} AS {n}" for n, sql in plain.items())
    spark = rows.sparkSession
    found = spark.sql(
        f"""
        SELECT block, parent, array({turns}) AS path, {BLOCK} - bit_count(grouping_id()) AS d,
               min(conv_id) AS conv_id, {other}, {each}
        FROM (SELECT *, {columns} FROM {{rows}})
        GROUP BY block, parent, ROLLUP({turns})
        """,
        rows=rows,
    )
    whole = F.expr("IF(d = 0, block = 0, get(path, d - 1) IS NOT NULL)")  # else nobody has d turns, or the block before says it
    return found.filter(whole).select(
        "conv_id",
        (F.col("block") * BLOCK + F.col("d")).alias("depth"),
        _chain(F.col("parent"), F.col("path"), F.col("d")).alias("name"),
        *plain,
        *(F.get(n, F.col("d")).alias(n) for n in by_place),
    )


def _later_sums(values: DataFrame) -> DataFrame:
    """`conv_id, block, own, later` of `conv_id, depth, value`: the block's values, and the sum behind it.

    A long conversation's blocks are summed in runs first, so that no window holds
    more than `RUN` blocks, or one row per run.
    """
    at = (F.col("depth") - 1) % BLOCK
    block = F.floor((F.col("depth") - 1) / BLOCK)
    own = [F.sum(F.when(at == i, F.col("value")).otherwise(0)) for i in range(BLOCK)]
    blocks = values.groupBy("conv_id", block.alias("block")).agg(F.array(*own).alias("own"), F.sum("value").alias("total"))
    blocks = staged(blocks.withColumn("run", F.floor(F.col("block") / RUN)), "trie-values")
    behind = lambda keys, by: Window.partitionBy(*keys).orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    runs = blocks.groupBy("conv_id", "run").agg(F.sum("total").alias("total"))
    runs = runs.select("conv_id", "run", F.sum("total").over(behind(["conv_id"], "run")).alias("behind_run"))
    inside = F.sum("total").over(behind(["conv_id", "run"], "block"))
    summed = blocks.withColumn("inside", inside).join(runs, ["conv_id", "run"])
    later = F.coalesce("inside", F.lit(0)) + F.coalesce("behind_run", F.lit(0))
    return summed.select("conv_id", "block", "own", later.alias("later"))


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of all prefixes, and the node at which each conversation ends.

    `turns` and `sizes` are as `share_openings` returns them. A node is `conv_id`, its
    smallest member, and `depth`: its turns are that conversation's first `depth` ones.
    `parent_conv_id` is the parent's smallest member, `n_convs` counts members,
    `n_children` children, `n_leaves` childless nodes of the subtree, and `saved` sums
    (members - 1) times the length of the last text over the subtree. The second table
    has `depth, name, conv_id` of each conversation's end; `name` is that of its node.
    Without conversations there is no node, not even a root.
    """
    most, root = sizes.agg(F.max("n_turns"), F.min("conv_id")).first()
    rows = _blocks(turns, sizes, most or 0)
    lengths = "max(IF({d} = 0, 0, get(length, {d} - 1)))"
    plain = {"n_convs": "count(*)", "longest": "max(n_turns)"}
    nodes = staged(_rollup(rows, {"length": lengths}, plain).drop("name"), "trie-nodes")

    owners = nodes.groupBy("conv_id").agg(
        (F.min("depth") - 1).alias("shared"), F.max((F.col("depth") == F.col("longest")).cast("int")).alias("leaf")
    )
    saved = nodes.filter("n_convs > 1 and depth > 0").select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("length")).alias("value")
    )
    sums = _later_sums(saved)
    # What a conversation owns in later blocks also counts for the blocks in which it owns nothing.
    known = rows.join(owners, "conv_id", "left").withColumns(
        {"shared": F.coalesce("shared", "n_turns"), "leaf": F.coalesce("leaf", F.lit(0))}
    )
    totals = sums.withColumn("total", F.expr("aggregate(own, 0L, (x, y) -> x + y) + later"))
    totals = totals.groupBy("conv_id").agg(
        F.max("total").alias("all_saved"),
        F.min("block").alias("first_saved"),
        F.max("block").alias("last_saved"),
    )
    known = known.join(sums, ["conv_id", "block"], "left").join(totals, "conv_id", "left")
    empty = F.array(*[F.lit(0).cast("long")] * BLOCK)
    # Owned blocks with shared nodes follow one another, as members only become fewer with depth.
    later = F.when(F.col("block") < F.col("first_saved"), F.col("all_saved")).otherwise(0)
    known = known.withColumns({"own": F.coalesce("own", empty), "later": F.coalesce("later", later, F.lit(0).cast("long"))})
    known = staged(known.drop("all_saved", "first_saved", "last_saved"), "trie-known")

    depth = f"(block * {BLOCK} + {{d}})"
    sums_of = {
        "length": lengths,
        "n_children": f"sum(int(shared <= {depth} AND {depth} < n_turns))",
        "saved": "sum(aggregate(slice(own, greatest({d}, 1), 8), later, (x, y) -> x + y))".replace("8", str(BLOCK)),
    }
    trie = staged(_rollup(known, sums_of, plain | {"n_leaves": "sum(leaf)"}), "trie-subtrees")

    # A node's parent has the same smallest member, but for the first node that a conversation owns.
    branches = known.filter("shared >= 0 and shared < n_turns and (shared = 0 and block = 0 "
                            f"or shared > 0 and block = floor((shared - 1) / {BLOCK}))")
    branches = branches.select(
        "conv_id",
        F.col("shared"),
        _chain(F.col("parent"), F.col("said"), (F.col("shared") - F.col("block") * BLOCK).cast("int")).alias("name"),
    )
    forks = trie.filter("n_children > 0 and depth > 0").select(
        "name", F.col("depth").alias("shared"), F.col("conv_id").alias("above")
    )
    above = branches.filter("shared > 0").join(forks, ["name", "shared"]).select("conv_id", "shared", "above")
    below_root = branches.filter("shared = 0").select("conv_id", "shared", F.lit(root).cast("long").alias("above"))
    above = above.unionByName(below_root).select("conv_id", (F.col("shared") + 1).alias("depth"), "above")
    found = trie.join(above, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "name",
        F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved",
        "length",
    )
    last = rows.filter(f"n_turns = 0 or block = floor((n_turns - 1) / {BLOCK})")
    ends = last.select(
        F.col("n_turns").alias("depth"), _chain(F.col("parent"), F.col("said"), F.size("said")).alias("name"), "conv_id"
    )
    return found, ends


def _running_sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of rows of one node; a partition holds all rows of a node, in order."""
    node, running = None, None
    schema = pa.schema([("depth", pa.int64()), ("name", pa.binary()), ("ends_sha256", pa.string())])

    def finished() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"depth": node[0], "name": node[1], "ends_sha256": running.hexdigest()}], schema)

    for batch in batches:
        for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
            if (depth, name) != node:
                if node is not None:
                    yield finished()
                node, running = (depth, name), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if node is not None:
        yield finished()


def end_digests(ends: DataFrame) -> DataFrame:
    """`depth, name, ends_sha256`: SHA-256 of the ascending, comma-joined identifiers that end at a node.

    Identifiers are gathered in chunks of up to `CHUNK` consecutive ones. A node with one
    chunk is hashed at once; of the others a task reads the chunks in order and keeps only
    the running hash, since SHA-256 has no other way.
    """
    chunk = F.floor(F.col("conv_id") / CHUNK)
    chunks = ends.groupBy("depth", "name", chunk.alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")
    )
    chunks = staged(chunks, "trie-ends")
    counted = chunks.groupBy("depth", "name").agg(F.count("*").alias("n"), F.min("chunk").alias("chunk"))
    whole = chunks.join(counted.filter("n = 1"), ["depth", "name", "chunk"])
    whole = whole.select("depth", "name", F.sha2("ids", 256).alias("ends_sha256"))
    parts = chunks.join(counted.filter("n > 1").select("depth", "name"), ["depth", "name"])
    in_order = parts.repartition("depth", "name").sortWithinPartitions("depth", "name", "chunk")
    schema = "depth long, name binary, ends_sha256 string"
    return whole.unionByName(in_order.mapInArrow(_running_sha256, schema))


def digested_trie(turns: DataFrame) -> DataFrame:
    """The trie of `conversations` rebuilt on shared openings, one row per node.

    `ends_sha256` hashes the conversations that end at the node; where none does it is
    the hash of nothing. Null roles and texts are empty ones, null turns come first,
    rows without conversation are left out, and an empty table gives no row.
    """
    rebuilt, sizes = share_openings(ordered_turns(turns))
    nodes, ends = prefix_trie(staged(rebuilt, "trie-rebuilt"), sizes)
    nothing = hashlib.sha256(b"").hexdigest()
    whole = nodes.join(end_digests(ends), ["depth", "name"], "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
