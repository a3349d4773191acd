"""Mixing sources to target weights by pivotal dependent rounding.

A document is to be taken target / source size times. The whole part of that is taken
as it is; the fraction is rounded jointly for a source's documents: two fractional
documents meet, and words move from one to the other, in a direction drawn so that each
keeps its expectation, until one of them is taken whole or not at all. What they hold
together never changes. The documents of a source meet in groups of `GROUP`; each group
leaves one fractional document, and those meet one level up, until one is left. Before
that, each document that is long for its source meets all shorter ones as a pool, since
single short ones could not make up for it.
Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import staged
from tillroll.llm.numbering import numbered

GROUP = 64  # fractional documents that meet in one group
LONG = 1_000  # a document with more than one of so many parts of its source is long
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SEED = 13


def n_words(text: Column) -> Column:
    """Words of a text, by white space; null has none. No list of words is built."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(marks, SPACE, "")).cast("long")


def source_targets(docs: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """`source, source_size, target` of `docs` (`source, size`).

    Sources in the order of their code points, null last, have the weights in turn. They
    divide `share` of all words by weight, but none gets more than `most` times its own
    words; the rest is divided again by weight among the others, until it fits.
    """
    sizes = staged(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    listed = sizes.withColumn("all", F.lit(0))  # sources may be many, so they are numbered apart, too
    placed = numbered(listed, "all", [F.col("source").asc_nulls_last()], "place", "mix-places").drop("all")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int"))
    table = staged(placed.withColumns({"weight": weight, "top": F.col("source_size") * most}), "mix-weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per weight of the sources that are not full
    while True:
        full = F.col("top") <= F.col("weight") * F.lit(level)
        held, open_weight = table.agg(F.sum(F.when(full, F.col("top"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight or (raised := (total * share - (held or 0.0)) / open_weight) <= level:
            break
        level = raised
    target = F.least(F.col("top"), F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def _meet(group: Column) -> Column:
    """The pivotal method over one group: `open`, its last document, and `closed`, the others.

    Members are `place, size, words, luck, row`: `words` of `size` are to be taken,
    `luck` in [0, 1) decides the document's meeting.
    """
    first = F.get(group, F.lit(0))
    start = F.struct(first.alias("open"), F.slice(group, 1, 0).alias("closed"))

    def step(so_far: Column, other: Column) -> Column:
        one = so_far["open"]
        # Words that can move to the one, or from it, before either of the two is whole or empty.
        to_one = F.least(one["size"] - one["words"], other["words"])
        from_one = F.least(one["words"], other["size"] - other["words"])
        gains = other["luck"] * (to_one + from_one) < from_one

        def with_words(doc: Column, words: Column) -> Column:
            return doc.withField("words", words)

        gain = F.when(
            one["size"] - one["words"] <= other["words"],
            F.struct(
                with_words(other, other["words"] - to_one).alias("open"),
                with_words(one, one["size"]).alias("done"),
            ),
        ).otherwise(
            F.struct(
                with_words(one, one["words"] + to_one).alias("open"),
                with_words(other, F.lit(0.0)).alias("done"),
            )
        )
        loss = F.when(
            one["words"] <= other["size"] - other["words"],
            F.struct(
                with_words(other, other["words"] + from_one).alias("open"),
                with_words(one, F.lit(0.0)).alias("done"),
            ),
        ).otherwise(
            F.struct(
                with_words(one, one["words"] - from_one).alias("open"),
                with_words(other, other["size"]).alias("done"),
            )
        )
        met = F.when(gains, gain).otherwise(loss)
        return F.struct(met["open"].alias("open"), F.concat(so_far["closed"], F.array(met["done"])).alias("closed"))

    return F.aggregate(F.slice(group, 2, GROUP), start, step)


def _luck(*of: str | int) -> Column:
    """A number in [0, 1) that only depends on its arguments: names of columns, and a step's number."""
    drawn = F.xxhash64(F.lit(SEED), *(F.col(x) if isinstance(x, str) else F.lit(x) for x in of))
    return drawn.bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)


def _round(docs: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Documents (`source_no, place, size, words, row`) that are whole or empty now, and one open per source.

    A level's groups are neighbours by place, at most `GROUP` of them whatever a source has.
    """
    rounded, step = [], 0
    most = docs.agg(F.max("place") + 1).first()[0] or 0
    while most > 1:
        step += 1
        member = F.struct("place", "size", "words", _luck(step, "source_no", "place").alias("luck"), "row")
        groups = docs.groupBy("source_no", F.floor(F.col("place") / GROUP).alias("group"))
        met = groups.agg(_meet(F.sort_array(F.collect_list(member))).alias("met"))
        met = staged(met.select("source_no", "group", "met.open", "met.closed"), "mix-groups")
        rounded.append(met.select(F.explode("closed").alias("doc")).select("doc.row", "doc.words", "doc.size"))
        docs = met.select("source_no", F.col("group").alias("place"), "open.size", "open.words", "open.row")
        most = -(-most // GROUP)
    return rounded, docs


def _meet_pools(group: Column) -> Column:
    """A source's long documents, longest first, each against all shorter documents as one.

    Words move between a document and its pool like between two documents; the pool's part
    is shared by all of its documents in proportion to their size. Members are `shorter,
    size, words, luck, row`, `shorter` the words of all shorter documents. Returns
    `share`, what is then to be taken of each document that is not long, and `closed`.
    """
    first = F.get(group, F.lit(0))
    start = F.struct((first["words"] / first["size"]).alias("share"), F.slice(group, 1, 0).alias("closed"))

    def step(so_far: Column, one: Column) -> Column:
        words, pool = so_far["share"] * one["size"], so_far["share"] * one["shorter"]
        to_one, from_one = F.least(one["size"] - words, pool), F.least(words, one["shorter"] - pool)
        moved = F.when(one["luck"] * (to_one + from_one) < from_one, to_one).otherwise(-from_one)
        share = F.least(F.greatest((pool - moved) / one["shorter"], F.lit(0.0)), F.lit(1.0))
        done = one.withField("words", words + moved)
        share = F.when(one["shorter"] > 0, share).otherwise(so_far["share"])
        return F.struct(share.alias("share"), F.concat(so_far["closed"], F.array(done)).alias("closed"))

    return F.aggregate(group, start, step)


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """`doc_id, size, source_size, target, taken` of every row.

    `size` counts the text's words, `target` is the source's, `taken` the words of the
    document's whole copies, at most `most` times its size. A source's taken words differ
    from its target by at most half of 1 / `LONG` of its words, or, where shorter documents
    cannot make up for a long one, by half of that. Draws are hashes of a document's number within its source, so reruns
    agree. Null texts and texts without words have size 0 and take 0; repeated rows and rows
    without identifier are documents of their own; a null source is a source; an empty table
    gives no rows.
    """
    counted = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    sized = staged(counted, "mix-sizes")
    targets = source_targets(sized, weights, share, most)
    targets = staged(targets.withColumn("source_no", F.monotonically_increasing_id()), "mix-targets")
    its = targets.withColumnRenamed("source", "its_source")
    joined = sized.join(its, sized["source"].eqNullSafe(its["its_source"]))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = joined.withColumn("ratio", ratio).withColumns(
        {"whole": F.floor("ratio"), "words": (F.col("ratio") - F.floor("ratio")) * F.col("size")}
    )
    row = ["doc_id", "size", "source_size", "target", "whole", "words", "text_hash", "source_no"]
    planned = staged(planned.select(row), "mix-planned")
    fractional = planned.filter("words > 0")
    by_length = [F.col("size").desc(), F.xxhash64(F.lit(SEED), "doc_id", "text_hash").asc(), F.col("doc_id").asc()]
    kept = F.struct("doc_id", "size", "source_size", "target", "whole")
    placed = numbered(fractional, "source_no", by_length, "place", "mix-numbered").select(
        "source_no", "place", F.col("size").cast("double").alias("size"), "words", kept.alias("row")
    )
    placed = staged(placed, "mix-placed")
    is_long = F.col("size") * LONG > F.col("row.source_size")
    others = placed.filter(~is_long)
    rest = others.groupBy("source_no").agg(F.sum("size").alias("rest"))
    # A source has fewer than LONG long documents, whatever its size.
    behind = Window.partitionBy("source_no").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, -1)
    shorter = F.coalesce(F.sum("size").over(behind), F.lit(0.0)) + F.coalesce("rest", F.lit(0.0))
    long = placed.filter(is_long).join(rest, "source_no", "left").withColumn("shorter", shorter)
    luck = _luck(0, "source_no", "place").alias("luck")
    member = F.struct("place", "shorter", "size", "words", luck, "row")
    pools = long.groupBy("source_no").agg(_meet_pools(F.sort_array(F.collect_list(member))).alias("met"))
    pools = staged(pools.select("source_no", "met.share", "met.closed"), "mix-pools")
    others = others.join(pools.select("source_no", "share"), "source_no", "left").withColumn(
        "words", F.coalesce(F.col("share") * F.col("size"), F.col("words"))
    )
    rounded, last = _round(staged(others.drop("share"), "mix-others"))
    # An open document goes to its nearer end, which keeps the source next to its target.
    nearer = F.when(F.col("words") * 2 >= F.col("size"), F.col("size")).otherwise(0.0).alias("words")
    closed = pools.select(F.explode("closed").alias("doc")).select("doc.row", "doc.words", "doc.size")
    done = closed.unionByName(last.select("row", "words", "size")).select("row", nearer, "size")
    for part in rounded:
        done = done.unionByName(part)
    done = done.select("row.*", (F.col("words") > 0).cast("long").alias("more"))
    untouched = planned.filter("words = 0").select(
        "doc_id", "size", "source_size", "target", "whole", F.lit(0).cast("long").alias("more")
    )
    return done.unionByName(untouched).select(
        "doc_id", "size", "source_size", "target", ((F.col("whole") + F.col("more")) * F.col("size")).alias("taken")
    )
