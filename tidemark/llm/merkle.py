"""Merkle manifest of a dataset: bitmaps rank the leaves, keyed slot arrays reduce the levels.

Every document is a leaf, the SHA-256 of its fields.  The leaves of a source ascend by id; runs of ``FAN`` nodes become
their hash until one, the source's subroot, is left, and the subroots, ordered by source, give the root the same way.

*Coordinates without a sort.*  The ids of a source are a bitmap, kept as its non-zero words of 64 bits.  Words of equal
coordinates are merged by OR, map-side first, and carry their popcount.  Directories over 16 bits of the id each (words
in a block, blocks in a superblock, and so on) hold the popcount before each entry; an entry has at most 65,536 siblings,
so no directory meets in one task, whatever the ids or however hot the source.  The rank of a leaf is the directories'
sum and the popcount below its bit.

*Levels by slots.*  A node's rank names its chunk of ``FAN ** 3`` nodes and its slot in it.  A chunk is collected as a map
from slot to digest and read in slot order; three levels are hashed in it, and the chunks' tops are the nodes of the next
round.  A round's chunks are stored, so lost executors cost no more than the round at work.

*Proofs.*  Going down again, each node hands the siblings on its way to the root to the nodes below it; a leaf of the
first round gets those of its chunk once and adds its own.  ``audit`` folds a leaf as it is found now with the siblings of
the manifest and compares the result with the root.

Defined cases: a null field is hashed as ``-``; null and empty texts differ; a null source is a source of its own, ordered
first.  Null ids come first in their source.  Rows of one id are ordered by their leaf; equal rows are leaves of their own.
Null or repeated ids cannot be bits, so in a table that has any, rows are numbered in that order by a range partitioning
and the numbers take the ids' place.  An empty table has no rows and no root.  Texts are hashed whole.  Other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, stored

FAN_BITS = 4
FAN = 1 << FAN_BITS
#: Levels that one chunk reduces.
DEPTH = 3
CHUNK = FAN**DEPTH
WORD_BITS, LEVEL_BITS = 6, 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def digest(*values: Column) -> Column:
    """SHA-256 of the concatenated values as lowercase hex."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def tampered_leaf(share: int = 5) -> Column:
    """The leaf of a changed copy: every ``share``-th row by checksum of its id has its text's A-Z lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % share == 0
    return F.when(chosen, leaf_of(text=F.translate("text", UPPER, LOWER)))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: id, source, pos, leaf, found.  ``subroots``: source, subroot.  ``rounds`` and ``top``: chunk tables, lowest first."""

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]


# --- ranks -----------------------------------------------------------------------------------------------------------


def _before(df: DataFrame, parent: list[str], order: str, n: str) -> Column:
    """Sum of ``n`` over the siblings before this row; a parent has at most 2 ** 16 entries."""
    w = Window.partitionBy(*parent).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def _directory(counts: DataFrame, shift: int) -> DataFrame:
    """(group, block, before) from (group, block, n), ``block`` being the key shifted by ``shift`` bits."""
    if shift + LEVEL_BITS >= 64:
        return counts.select("group", "block", _before(counts, ["group"], "block", "n").alias("before"))
    parent = F.shiftright("block", LEVEL_BITS).alias("parent")
    upper = counts.groupBy("group", parent).agg(F.sum("n").alias("n")).withColumnRenamed("parent", "block")
    above = _directory(upper, shift + LEVEL_BITS).select(
        F.col("group").alias("g"), F.col("block").alias("parent"), F.col("before").alias("above")
    )
    own = counts.withColumn("parent", parent)
    own = own.select("group", "parent", "block", _before(own, ["group", "parent"], "block", "n").alias("own"))
    joined = own.join(above, own["group"].eqNullSafe(above["g"]) & (own["parent"] == above["parent"]))
    return joined.select("group", "block", (F.col("own") + F.col("above")).alias("before"))


def bitmap(rows: DataFrame) -> DataFrame:
    """Non-zero words of the groups' bitmaps: (group, word, bits, before), ``before`` counting the bits set below the word."""
    bit = F.expr(f"shiftleft(1L, cast(key & {(1 << WORD_BITS) - 1} as int))")
    words = rows.groupBy("group", F.shiftright("key", WORD_BITS).alias("word")).agg(F.bit_or(bit).alias("bits"))
    block = F.shiftright("word", LEVEL_BITS - WORD_BITS).alias("block")
    words = words.select("group", block, "word", "bits", F.bit_count("bits").cast("long").alias("n"))
    counts = words.groupBy("group", "block").agg(F.sum("n").alias("n"))
    directory = _directory(counts, LEVEL_BITS).select(
        F.col("group").alias("g"), F.col("block").alias("b"), F.col("before").alias("above")
    )
    inside = words.withColumn("inside", _before(words, ["group", "block"], "word", "n"))
    joined = inside.join(directory, inside["group"].eqNullSafe(directory["g"]) & (inside["block"] == directory["b"]))
    return joined.select("group", "word", "bits", (F.col("inside") + F.col("above")).alias("before"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (group, key, ...) with ``pos``, the number of smaller keys in the group.  Keys are unique in their group."""
    words = bitmap(rows.select("group", "key")).select(F.col("group").alias("g"), "word", "bits", "before")
    at = F.shiftright("key", WORD_BITS)
    joined = rows.join(words, rows["group"].eqNullSafe(words["g"]) & (at == words["word"]))
    below = F.expr(f"bits & ~shiftleft(-1L, cast(key & {(1 << WORD_BITS) - 1} as int))")
    return joined.select(*rows.columns, (F.col("before") + F.bit_count(below)).alias("pos"))


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with a ``key`` that ascends in ``order``; what is equal there goes by its place in the input, so that copies spread."""
    placed = rows.withColumn("place!", F.monotonically_increasing_id())
    by = [*order, F.col("`place!`")]
    sliced = placed.repartitionByRange(*by).sortWithinPartitions(*by).drop("place!")
    return stored(sliced.withColumn("key", F.monotonically_increasing_id()), "merkle-order")


# --- levels ----------------------------------------------------------------------------------------------------------


def _above(nodes: Column) -> Column:
    """The next level: runs of ``FAN`` nodes become their digest."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FAN).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(F.concat_ws("", F.slice(nodes, i * FAN + 1, FAN)).cast("binary"), 256))


def _depth(n: Column) -> Column:
    """Levels a chunk of a tree of ``n`` nodes is reduced by."""
    return reduce(lambda d, k: F.when(n > FAN**k, k + 1).otherwise(d), range(1, DEPTH), F.when(n > 1, 1).otherwise(0))


def _in_order(keyed: str) -> Column:
    """Values of a map from 0, 1, 2 ... as an array."""
    return F.transform(F.sequence(F.lit(0), F.size(keyed) - 1), lambda k: F.col(keyed)[k])


def _chunks(nodes: DataFrame) -> DataFrame:
    """Chunks of a round, from (group, pos, n, node): (group, chunk, n, slots, levels), ``levels`` being the arrays above."""
    keys = ["group", "chunk", "n"]
    run = (F.shiftright("pos", FAN_BITS) % (CHUNK // FAN)).cast("int").alias("run")
    slot = (F.col("pos") % FAN).cast("int").alias("slot")
    chunk = F.shiftright("pos", FAN_BITS * DEPTH).alias("chunk")
    placed = nodes.select("group", chunk, "n", run, slot, "node").repartition("group", "chunk")
    # Slots within runs, runs within the chunk: looking a key up walks its map, so maps stay small.
    runs = placed.groupBy(*keys, "run").agg(F.map_from_entries(F.collect_list(F.struct("slot", "node"))).alias("keyed"))
    runs = runs.select(*keys, "run", _in_order("keyed").alias("nodes"))
    chunks = runs.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("run", "nodes"))).alias("keyed"))
    slots = chunks.select(*keys, F.flatten(_in_order("keyed")).alias("slots"))
    levels, below = [], F.col("slots")
    depth = _depth(F.col("n"))
    for k in range(DEPTH):
        name = f"level{k + 1}"
        slots = slots.withColumn(name, F.when(depth > k, _above(below)))
        levels.append(F.col(name))
        below = F.col(name)
    return slots.select("group", "chunk", "n", "slots", F.array_compact(F.array(*levels)).alias("levels"))


def _top(chunks: DataFrame) -> DataFrame:
    """What a round leaves: one node for each chunk."""
    last = F.when(F.size("levels") > 0, F.element_at("levels", -1)).otherwise(F.col("slots"))
    n = F.greatest(F.ceil(F.col("n") / CHUNK), F.lit(1)).cast("long")
    return chunks.select("group", F.col("chunk").alias("pos"), n.alias("n"), last[0].alias("node"))


def reduce_levels(nodes: DataFrame, label: str) -> list[DataFrame]:
    """All rounds of the trees over (group, pos, node), each stored; ``_top`` of the last holds the groups' roots."""
    sizes = nodes.groupBy("group").agg(F.count("*").alias("n")).select(F.col("group").alias("g"), "n")
    nodes = nodes.join(sizes, nodes["group"].eqNullSafe(sizes["g"])).select("group", "pos", "n", "node")
    rounds = []
    while True:
        rounds.append(stored(_chunks(nodes), label))
        if (rounds[-1].agg(F.max("n")).head()[0] or 0) <= CHUNK:
            return rounds
        nodes = _top(rounds[-1])


def build(docs: DataFrame, found: Column | None = None) -> Manifest:
    """The manifest of ``docs``.  ``found`` is a leaf that an auditor sees in place of the true one, null where it is the same."""
    found = F.lit(None).cast("string") if found is None else found
    leaves = stored(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").alias("group"), leaf_of().alias("leaf"), found.alias("found")),
        "merkle-leaves",
    )
    repeated = leaves.groupBy("group", "id").count().filter((F.col("count") > 1) | F.col("id").isNull()).limit(1)
    if repeated.isEmpty():
        rows = leaves.withColumn("key", F.col("id"))
    else:
        rows = _numbered(leaves, [F.asc_nulls_first("group"), F.asc_nulls_first("id"), F.col("leaf")])
    leaves = stored(ranked(rows).drop("key"), "merkle-ranks")
    rounds = reduce_levels(leaves.select("group", "pos", F.col("leaf").alias("node")), "merkle-round")
    subroots = _top(rounds[-1]).select(F.col("group").alias("source"), F.col("node").alias("subroot"))
    ordered = _numbered(subroots, [F.asc_nulls_first("source")]).withColumn("group", F.lit(0))
    subroots = stored(ranked(ordered).select("source", "subroot", "pos"), "merkle-subroots")
    top = reduce_levels(subroots.select(F.lit(0).alias("group"), "pos", F.col("subroot").alias("node")), "merkle-top")
    return Manifest(leaves, rounds, subroots, top)


# --- proofs ----------------------------------------------------------------------------------------------------------


def _siblings(nodes: Column, at: Column) -> Column:
    """The other nodes of the run that holds node ``at``, left and right of it, as text."""
    start, inside = F.floor(at / FAN).cast("int") * FAN, at % FAN
    return F.struct(
        F.concat_ws("", F.slice(nodes, start + 1, inside)).alias("left"),
        F.concat_ws("", F.slice(nodes, at + 2, FAN - 1 - inside)).alias("right"),
    )


def _way(levels: Column, at: Column, first: int) -> Column:
    """Siblings from level ``first`` of a chunk to its top, for slot ``at`` of level 0; ``levels`` holds them all."""
    return F.transform(
        F.filter(F.sequence(F.lit(first), F.lit(DEPTH)), lambda k: k < F.size(levels) - 1),
        lambda k: _siblings(levels[k], F.floor(at / F.pow(F.lit(FAN), k)).cast("int")),
    )


def _with_path(chunks: DataFrame, paths: DataFrame) -> DataFrame:
    """Chunks with all their levels, the path of their top node and the root: (group, chunk, levels, path, root)."""
    upper = paths.select(F.col("group").alias("g"), F.col("pos").alias("p"), "path", "root")
    joined = chunks.join(upper, chunks["group"].eqNullSafe(upper["g"]) & (chunks["chunk"] == upper["p"]))
    levels = F.concat(F.array("slots"), F.col("levels"))
    return joined.select("group", "chunk", levels.alias("levels"), "path", "root")


def _runs(chunks: DataFrame, paths: DataFrame) -> DataFrame:
    """Runs of a round's nodes: (group, pos of the first, run, path above, hashed, root)."""
    size = F.size(F.col("levels")[0])
    starts = F.sequence(F.lit(0), size - 1, F.lit(FAN))
    rows = _with_path(chunks, paths).select("*", F.explode(starts).alias("start"))
    return rows.select(
        "group",
        (F.col("chunk") * CHUNK + F.col("start")).alias("pos"),
        F.slice(F.col("levels")[0], F.col("start") + 1, FAN).alias("run"),
        (F.size("levels") > 1).alias("hashed"),
        F.concat(_way(F.col("levels"), F.col("start"), 1), F.col("path")).alias("path"),
        "root",
    )


def _descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """From the paths of the groups' roots to the runs of the lowest round."""
    for chunks in reversed(rounds[1:]):
        runs = _runs(chunks, paths).select("*", F.posexplode("run").alias("slot", "node"))
        own = F.when(F.col("hashed"), F.array(_siblings(F.col("run"), F.col("slot")))).otherwise(F.array().cast(PATH))
        paths = runs.select("group", (F.col("pos") + F.col("slot")).alias("pos"), F.concat(own, "path").alias("path"), "root")
    return _runs(rounds[0], paths)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its siblings."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def audit(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified."""
    end = manifest.top[-1]
    root = _top(end).select("group", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    upper = _descend(manifest.top, root).select("*", F.posexplode("run").alias("slot", "node"))
    own = F.when(F.col("hashed"), F.array(_siblings(F.col("run"), F.col("slot")))).otherwise(F.array().cast(PATH))
    upper = upper.select((F.col("pos") + F.col("slot")).alias("pos"), F.concat(own, "path").alias("path"), "root")
    by_source = manifest.subroots.join(upper, "pos").select(
        F.col("source").alias("group"), F.lit(0).cast("long").alias("pos"), "path", F.struct("subroot", "root").alias("root")
    )
    runs = _descend(manifest.rounds, by_source)
    start = F.shiftleft(F.shiftright("pos", FAN_BITS), FAN_BITS).alias("start")
    members = manifest.leaves.groupBy("group", start).agg(
        F.collect_list(F.struct("id", (F.col("pos") % FAN).cast("int").alias("slot"), "found")).alias("members")
    )  # a run has no more than FAN leaves
    members = members.select(F.col("group").alias("g"), "start", "members")
    rows = runs.join(members, runs["group"].eqNullSafe(members["g"]) & (runs["pos"] == members["start"]))
    rows = rows.select("group", "run", "hashed", "path", "root", F.inline("members"))
    leaf = F.col("run")[F.col("slot")]
    own = F.when(F.col("hashed"), F.array(_siblings(F.col("run"), F.col("slot")))).otherwise(F.array().cast(PATH))

    def judged(path: Column) -> Column:
        siblings = F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))
        return F.struct(
            F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
            fold(F.coalesce(F.col("found"), leaf), path).alias("folded_root"),
        )

    found = rows.select(
        F.col("id").alias("doc_id"),
        F.col("group").alias("source"),
        leaf.alias("leaf"),
        F.col("root")["subroot"].alias("subroot"),
        F.col("root")["root"].alias("root"),
        let(F.concat(own, "path"), judged).alias("judged"),
    )
    return found.select(
        "doc_id", "source", "leaf", "subroot", "root", "judged.*",
        (F.col("judged")["folded_root"] == F.col("root")).alias("verified"),
    )
