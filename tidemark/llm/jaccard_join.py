"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows, recursive exact joins.

A document is its set of five-word shingles; two documents link when their Jaccard similarity is 0.8 or more.

Pivots chosen among all documents cannot divide a corpus: nearly all pairs of documents share nothing and are at distance
1, so every window of twice the radius holds nearly all documents of nearly all regions.  The space is therefore cut first
where distances do tell something: among documents that share one of the shingles of their *prefixes*.  All sets put
their shingles into one order; two sets with similarity 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of each.
Shingles that a sample finds in many documents come last in the order, so that few documents meet because of a common
passage.  Inside these cells the named method works:

1. *Pivot stars*: each cell's smallest document is its pivot; all members are compared with it.  Links are made into
   components, so that a large group of near copies is one component after linear work.
2. *Voronoi regions*: where a cell still holds several components, pairs across components are sought.  The counts of a
   set's shingles in 32 hash classes, compared on a circle of 256, make a vector whose L1 distance is a metric and never
   exceeds the symmetric difference.  Large cells choose pivots, each document goes to its nearest pivot and, by the
   triangle inequality, to all pivots within its distance plus twice the radius, and regions are joined recursively.
   First each document's nearest foreign candidates are verified and linked, then all candidates that are left.
3. Candidates are verified on whole texts.

Sets that are equal are folded first.  Hashes of shingles have 64 bits.

Defined cases: null, empty and blank texts have no shingles and link with nothing; repeated rows are documents with equal
sets; rows with null or repeated ids are documents of their own, and a component is named by the smallest id in it, null
only if all are; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, keyed, release_memory, stored
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_set

NUMERATOR, DENOMINATOR = 80, 100
CLASSES = 32  # for small sets; doubled until a class holds some ten shingles, up to MOST_CLASSES
MOST_CLASSES = 512
SAMPLE_DOCS = 10_000
COMMON_SHARE = 0.005  # of the sampled documents; such shingles are last in the order
LEAF = 48
PIVOTS = 8
EARLY = 5
EARLY_TYPE = [("position", "<i4"), ("shingle", "<i8")]
CELL_ROWS = 4000
NEAREST_ROUNDS = 1
SIZE_CLASS = DENOMINATOR / NUMERATOR


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def class_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall in each hash class, on a circle of 256."""
    classes = CLASSES
    while classes < MOST_CLASSES and 10 * classes < len(shingles):
        classes *= 2
    kept = ((shingles >> np.uint64(40)) & np.uint64(classes - 1)).astype(np.int64)
    return np.bincount(kept, minlength=classes).astype(np.uint8)


def folded(counts: list[bytes], classes: int) -> np.ndarray:
    """Counts of all sets in ``classes`` classes, from as many or more."""
    out = np.empty((len(counts), classes), np.uint8)
    for i, c in enumerate(counts):
        row = np.frombuffer(c, np.uint8)
        out[i] = row if len(row) == classes else row.reshape(-1, classes).sum(0, dtype=np.uint8)
    return out


def circular_l1(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between all rows of ``a`` and all rows of ``b``."""
    d = a[:, None, :] - b[None, :, :]
    return np.minimum(d, -d).sum(2, dtype=np.int32)


def prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles in the common order: by hash, common ones last."""
    k = prefix_length(len(shingles))
    if len(common):
        late = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] == shingles
        if late.any():
            return np.concatenate([shingles[~late], shingles[late]])[:k]
    return shingles[:k]


@dataclass(frozen=True)
class Rows:
    """The rows of some cells: sizes, components, the position of the cell's shingle in the set's order, and of the
    first shared shingles of the set those in front of it (0 where there is none); ``home`` tells the sets of the cell's own
    size class from those of the class below."""

    n: np.ndarray
    component: np.ndarray
    position: np.ndarray
    before: np.ndarray
    home: np.ndarray

    def part(self, begin: int, end: int) -> Rows:
        return Rows(*(getattr(self, f.name)[begin:end] for f in fields(self)))


def _fit(rows: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the pairs those in different components that may link and have not met in an earlier cell.

    At the first shingle that two sets share, what is left of either bounds the intersection.  Pairs that share one in
    front of this cell's are left to that one's cell, so that a pair comes up once and not in each of its cells.
    """
    n, left = rows.n, rows.n - rows.position
    fits = (rows.component[i] != rows.component[j]) & (rows.home[i] | rows.home[j])
    fits &= DENOMINATOR * np.minimum(n[i], n[j]) >= NUMERATOR * np.maximum(n[i], n[j])
    fits &= (NUMERATOR + DENOMINATOR) * np.minimum(left[i], left[j]) >= NUMERATOR * (n[i] + n[j])
    some = np.flatnonzero(fits)
    for lo in range(0, len(some), 20_000):
        s = some[lo : lo + 20_000]
        x, y = rows.before[i[s]][:, :, None], rows.before[j[s]][:, None, :]
        fits[s] = ~((x == y) & (x != 0)).any(axis=(1, 2))
    return fits


def _near(n: np.ndarray, counts: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the pairs that class counts do not rule out.

    Similarity s means a symmetric difference of (1 - s) / (1 + s) times the sum of the sizes.
    """
    size = np.fromiter(map(len, counts), np.int64, len(counts))
    classes = np.minimum(size[i], size[j])
    distance = np.zeros(len(i), np.int64)
    for k in np.unique(classes):
        some = np.flatnonzero(classes == k)
        rows, at = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
        table = folded([counts[r] for r in rows], int(k))
        a, b = at[: len(some)], at[len(some) :]
        for lo in range(0, len(some), 20_000):
            d = table[a[lo : lo + 20_000]] - table[b[lo : lo + 20_000]]
            distance[some[lo : lo + 20_000]] = np.minimum(d, -d).sum(1, dtype=np.int64)
    near = (NUMERATOR + DENOMINATOR) * distance <= (DENOMINATOR - NUMERATOR) * (n[i] + n[j])
    return i[near], j[near], distance[near]


def small_cells(begin: np.ndarray, size: np.ndarray, rows: Rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets within cells of at most ``LEAF`` rows, for all cells of one size at once."""
    for s in np.unique(size):
        one, two = np.triu_indices(int(s), 1)
        starts = begin[size == s]
        step = max(1, 100_000 // len(one))
        for lo in range(0, len(starts), step):
            base = starts[lo : lo + step][:, None]
            i, j = (base + one).ravel(), (base + two).ravel()
            keep = _fit(rows, i, j)
            yield i[keep], j[keep]


def regions(cell: Rows, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a large cell that may link: Voronoi regions with windows, joined recursively.

    A document x with its nearest pivot p and a partner y within the radius r of it: d(y, p) <= r + d(x, p) <=
    r + d(x, q) <= 2 r + d(y, q) for the pivot q nearest to y.  So y is in the window of p.
    """
    n, component = cell.n, cell.component
    pending = [np.arange(len(n))]
    while pending:
        rows = pending.pop()
        if len(rows) < 2 or (component[rows] == component[rows[0]]).all():
            continue
        if len(rows) > LEAF:
            chosen = rows[np.argsort(n[rows], kind="stable")[np.linspace(0, len(rows) - 1, PIVOTS).astype(int)]]
            far = np.concatenate([circular_l1(counts[rows[k : k + 512]], counts[chosen]) for k in range(0, len(rows), 512)])
            # For a pair that links, the sum of the sizes is at most 1 + 1 / s times the smaller one.
            radius = (DENOMINATOR - NUMERATOR) * n[rows] // NUMERATOR
            window = far <= (far.min(1) + 2 * radius)[:, None]
            parts = [rows[window[:, p]] for p in range(PIVOTS)]
            if max(map(len, parts)) <= 0.7 * len(rows):
                pending += parts
                continue
        for lo in range(0, len(rows), 64):
            i = np.repeat(rows[lo : lo + 64], len(rows))
            j = np.tile(rows, len(rows[lo : lo + 64]))
            i, j = i[i < j], j[i < j]
            keep = _fit(cell, i, j)
            yield i[keep], j[keep]


def cell_candidates(
    begin: np.ndarray, size: np.ndarray, rows: Rows, counts: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of all pairs within a cell that may link and are not in one component."""
    found = [(np.empty(0, np.int64),) * 3]
    small = size <= LEAF
    found += [_near(rows.n, counts, i, j) for i, j in small_cells(begin[small], size[small], rows)]
    for lo, s in zip(begin[~small].tolist(), size[~small].tolist()):
        part = counts[lo : lo + s]
        table = folded(part, min(map(len, part)))
        for i, j in regions(rows.part(lo, lo + s), table):
            found.append(_near(rows.n, counts, lo + i, lo + j))
    i, j, d = (np.concatenate(c) for c in zip(*found))
    return i, j, d


def _documents(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"].tolist(), batch["text"]):
                shingles = shingle_set((text or "").encode())
                # Empty sets are not folded: they link with nothing, not even with each other.
                bytes_ = shingles.tobytes() if len(shingles) else b"empty %d" % key
                digest = hashlib.blake2b(bytes_, digest_size=16).digest()
                rows.append((key, len(shingles), digest, class_counts(shingles).tobytes()))
            yield pd.DataFrame(rows, columns=["key", "n", "digest", "counts"])
        release_memory()

    return texts.mapInPandas(run, "key long, n long, digest binary, counts binary")


def _common(texts: DataFrame, total: int) -> np.ndarray:
    """Hashes of shingles that many documents of a bounded sample hold; they only order the prefixes."""
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    sample = texts.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set((t or "").encode()) for t in batch["text"]]
            token, n = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
            yield pd.DataFrame({"token": token.view(np.int64), "n": n})

    least = max(3, int(COMMON_SHARE * min(total, SAMPLE_DOCS)))
    counts = sample.mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # At most (shingles in the sample) / least tokens: bounded by the sample's size, not by the corpus.
    return np.sort(counts.filter(F.col("n") >= least).select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def _cells(texts: DataFrame, common: np.ndarray, buckets: int) -> DataFrame:
    """``token, key, position`` of prefix shingles that at least two documents share.

    Tasks pack what they send to a bucket of hashes into one binary row for each batch; copies within a task are sent
    once.  Common shingles are known to be shared and do not gather in a bucket.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()  # one digest for each text of the task's split
        for batch in batches:
            tokens, keys, places = [], [], []
            for key, text in zip(batch["key"].tolist(), batch["text"]):
                shingles = shingle_set((text or "").encode())
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                if len(shingles) and digest not in seen:
                    seen.add(digest)
                    first = prefix(shingles, shared.value)
                    tokens.append(first)
                    keys.append(np.full(len(first), key, np.int64))
                    places.append(np.arange(len(first), dtype=np.int32))
            if not tokens:
                continue
            token, key, place = np.concatenate(tokens), np.concatenate(keys), np.concatenate(places)
            bucket = ((token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            late = np.isin(token, shared.value)
            bucket[late] = buckets + key[late] % buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            packed = [[x.tobytes() for x in np.split(c[order], cut)] for c in (token, key, place)]
            yield pd.DataFrame({
                "bucket": bucket[order][np.append(0, cut)].astype(np.int32),
                "tokens": packed[0], "keys": packed[1], "places": packed[2],
            })

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = []
        for batch in batches:
            for bucket, t, k, p in batch.itertuples(index=False):
                columns = np.frombuffer(t, np.int64), np.frombuffer(k, np.int64), np.frombuffer(p, np.int32)
                if bucket >= buckets:
                    yield pd.DataFrame(dict(zip(("token", "key", "position"), columns)))
                else:
                    parts.append(columns)
        if parts:
            token, key, place = (np.concatenate(c) for c in zip(*parts))
            parts = None
            order = np.argsort(token, kind="stable")
            token, key, place = token[order], key[order], place[order]
            same = np.append(False, token[1:] == token[:-1])
            keep = same | np.append(same[1:], False)
            yield pd.DataFrame({"token": token[keep], "key": key[keep], "position": place[keep]})
        release_memory()

    packed = texts.mapInPandas(scatter, "bucket int, tokens binary, keys binary, places binary")
    return packed.repartitionById(2 * buckets, "bucket").mapInPandas(gather, "token long, key long, position int")


def _early(cells: DataFrame) -> DataFrame:
    """``key, early``: the first ``EARLY`` shared shingles of each set, as packed (position, shingle) pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [np.array([(p["position"], p["token"]) for p in x], EARLY_TYPE).tobytes() for x in batch["first"]]
            yield pd.DataFrame({"key": batch["key"], "early": packed})

    first = F.slice(F.sort_array(F.collect_list(F.struct("position", "token"))), 1, EARLY)  # of one set's prefix
    found = cells.groupBy("key").agg(first.alias("first")).mapInPandas(run, "key long, early binary")
    return stored(found, "jaccard-early")


def _verified(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose texts link; ``packed`` is ``key, z`` with compressed texts."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        last = (None, None)
        for batch in batches:
            unpack, links = zstandard.ZstdDecompressor().decompress, []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["za"], batch["zb"]):
                if last[0] != a:
                    last = (a, shingle_set(unpack(x)))
                first, second = last[1], shingle_set(unpack(y))
                both = len(np.intersect1d(first, second, assume_unique=True))
                if DENOMINATOR * both >= NUMERATOR * (len(first) + len(second) - both):
                    links.append((a, b))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
        release_memory()

    with_b = pairs.join(packed.select(F.col("key").alias("b"), F.col("z").alias("zb")), "b")
    with_both = with_b.join(packed.select(F.col("key").alias("a"), F.col("z").alias("za")), "a")
    return with_both.select("a", "b", "za", "zb").mapInPandas(check, "a long, b long")


def _plausible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs that sizes and class counts do not rule out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = len(batch)
            n = np.concatenate([batch["na"].to_numpy(), batch["nb"].to_numpy()])
            i, _, _ = _near(n, [*batch["ca"], *batch["cb"]], np.arange(m), np.arange(m, 2 * m))
            yield batch.iloc[i][["a", "b"]]

    def side(s: str) -> DataFrame:
        return info.select(F.col("key").alias(s), F.col("n").alias(f"n{s}"), F.col("counts").alias(f"c{s}"))

    joined = pairs.join(side("b"), "b").join(side("a"), "a").filter(
        DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb")
    )
    return joined.mapInPandas(run, "a long, b long")


def _conflicts(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of cells in which several components meet, with their components."""
    labelled = stored(
        cells.join(labels.select(F.col("node").alias("key"), "component"), "key", "left").select(
            "token", "key", "position", "home", F.coalesce("component", "key").alias("component")
        ),
        "cell-components",
    )
    mixed = labelled.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    return labelled.join(stored(mixed.select("token"), "mixed-cells"), "token")


def _candidates(conflicts: DataFrame, info: DataFrame, nearest: bool) -> DataFrame:
    """Distinct pairs across components.

    A cell of more than ``CELL_ROWS`` rows is cut: rows of its largest component are dealt to several parts, since they
    need no comparison with each other; the other rows go to every part.
    """
    sizes = conflicts.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    cells = sizes.groupBy("token").agg(F.max_by("component", "n").alias("largest"), F.sum("n").alias("rows"))
    cells = stored(cells.filter(F.col("rows") > CELL_ROWS), "large-cells")
    parts = F.coalesce(F.ceil(F.col("rows") / CELL_ROWS), F.lit(1)).cast("int")
    part = F.when(F.col("component") == F.col("largest"), F.array(F.pmod(F.xxhash64("key"), parts).cast("int"))).otherwise(
        F.sequence(F.lit(0), parts - 1)
    )
    rows = (
        conflicts.join(cells, "token", "left")
        .select("token", "key", "position", "home", "component", F.explode(F.coalesce(part, F.array(F.lit(0)))).alias("part"))
        .join(info, "key")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            last = (batch["token"] == batch["token"].iat[-1]) & (batch["part"] == batch["part"].iat[-1])
            done, rest = batch[~last], batch[last]
            yield from join(done)
        if rest is not None:
            yield from join(rest)
        release_memory()

    def join(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        token, part = rows["token"].to_numpy(), rows["part"].to_numpy()
        key, component, n = (rows[c].to_numpy(np.int64) for c in ("key", "component", "n"))
        begin = np.append(0, np.flatnonzero((token[1:] != token[:-1]) | (part[1:] != part[:-1])) + 1)
        size = np.diff(np.append(begin, len(token)))
        several = size > 1
        position = rows["position"].to_numpy(np.int64)
        early, at = np.zeros((len(rows), EARLY), np.int64), np.full((len(rows), EARLY), np.iinfo(np.int64).max)
        for r, shared in enumerate(rows["early"]):
            first = np.frombuffer(shared, EARLY_TYPE)
            at[r, : len(first)], early[r, : len(first)] = first["position"], first["shingle"]
        before = np.where(at < position[:, None], early, 0)
        cells_ = Rows(n, component, position, before, rows["home"].to_numpy(bool))
        i, j, d = cell_candidates(begin[several], size[several], cells_, rows["counts"].tolist())
        if nearest and len(i):
            i, j, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([d, d])
            order = np.lexsort((key[j], d, i))
            i, j = i[order], j[order]
            first = np.append(True, i[1:] != i[:-1])
            i, j = i[first], j[first]
        if len(i):
            a, b = key[i], key[j]
            found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    buckets = int(conflicts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartition(buckets, "token", "part").sortWithinPartitions("token", "part")
    names = ["token", "part", "key", "position", "home", "component", "n", "counts", "early"]
    return spread.select(*names).mapInPandas(run, "a long, b long").distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    base = keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", ["doc_id", "text"])
    labelled = _labels(base.select("key", "text"))
    ids = base.select("key", "doc_id").join(labelled, "key")
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return ids.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, columns unchanged: that with the smallest id."""
    packed = docs.select(F.col(id_col).alias("doc_id"), F.struct("*").alias("row"))
    base = keyed(packed, "doc_id", ["doc_id", "row"])
    labelled = _labels(base.select("key", F.col(f"row.{text_col}").alias("text")))
    firsts = (
        base.select("key", F.col("doc_id").isNull().alias("no"), "doc_id")
        .join(labelled.select("key", "component"), "key")
        .groupBy("component")
        .agg(F.min(F.struct("no", "doc_id", "key")).alias("first"))
        .select(F.col("first.key").alias("key"))
    )
    return base.join(firsts, "key", "left_semi").select("row.*")


def _labels(texts: DataFrame) -> DataFrame:
    """``key, n, component``; a component is named by one of its keys."""
    spark = texts.sparkSession
    bound_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    documents = stored(_documents(texts), "jaccard-documents")
    firsts = stored(documents.groupBy("digest").agg(F.min("key").alias("first")), "jaccard-firsts")
    members = stored(documents.join(firsts, "digest").select("key", "n", "first", "counts"), "jaccard-members")
    info = members.filter("key = first").select("key", "n", "counts")

    cells = stored(_cells(texts, _common(texts, documents.count()), buckets), "jaccard-cells")
    folded_ = cells.join(members.select("key", "first", "n"), "key").select("token", F.col("first").alias("key"), "n", "position")
    cells = stored(folded_.distinct(), "jaccard-cells-folded")
    info = info.join(_early(cells), "key")
    # Sets that link differ in size by a factor of ``SIZE_CLASS`` at most, so they meet in one of two neighbouring classes.
    size_class = F.floor(F.log("n") / F.log(F.lit(SIZE_CLASS)) + 1e-9).cast("int")
    own = F.struct(size_class.alias("size_class"), F.lit(True).alias("home"))
    next_ = F.struct((size_class + 1).alias("size_class"), F.lit(False).alias("home"))
    cells = cells.select("token", "key", "position", F.explode(F.array(own, next_)).alias("c")).select(
        F.xxhash64("token", "c.size_class").alias("token"), "key", "position", "c.home"
    )
    # A cell without a set of its own size class is left out: its sets meet in their own class as well.
    ends = F.min("key").alias("a"), F.max("key").alias("z"), F.max("home").alias("own")
    pivots = stored(cells.groupBy("token").agg(*ends).filter("a <> z and own").select("token", "a"), "jaccard-pivots")
    cells = stored(cells.join(pivots, "token"), "jaccard-shared-cells")
    stars = cells.filter("a <> key").select("a", F.col("key").alias("b"))
    cells = cells.drop("a")
    pairs = stored(_plausible(stars.distinct(), info), "jaccard-pairs")

    # Texts are needed of those that share a cell with another set only, and travel compressed.
    wanted = cells.select("key").distinct()

    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for batch in batches:
            pack = zstandard.ZstdCompressor(level=1).compress
            yield pd.DataFrame({"key": batch["key"], "z": [pack((t or "").encode()) for t in batch["text"]]})

    packed = stored(texts.mapInPandas(compress, "key long, z binary").join(wanted, "key", "left_semi"), "jaccard-texts")

    links = stored(_verified(pairs, packed), "jaccard-links")
    labels = stored(components(links), "jaccard-components")
    conflicts = stored(_conflicts(cells, labels), "jaccard-conflicts")
    for turn in range(NEAREST_ROUNDS + 1):
        if conflicts.limit(1).isEmpty():
            break
        more = _candidates(conflicts, info, nearest=turn < NEAREST_ROUNDS)
        found = stored(_verified(stored(more, "jaccard-candidates"), packed), "jaccard-links")
        if turn < NEAREST_ROUNDS and found.limit(1).isEmpty():
            continue
        links = links.unionByName(found)
        labels = stored(components(links), "jaccard-components")
        if turn < NEAREST_ROUNDS:
            conflicts = stored(_conflicts(conflicts.select("token", "key", "position", "home"), labels), "jaccard-conflicts")
    named = members.join(labels.select(F.col("node").alias("first"), "component"), "first", "left")
    return named.select("key", "n", F.coalesce("component", "first").alias("component"))
