"""Suffix-array deduplication: bytes covered by a string of ``LENGTH`` bytes that starts anywhere else as well.

Sorting the suffixes at every byte would move each text hundreds of times, so the suffix array is sparse, without loss:

1. Every window of ``LENGTH`` bytes names an *anchor* inside itself: the leftmost of its positions with the smallest hash
   of the 8 bytes there.  Equal windows have equal anchors at equal offsets.  Some 1 in 170 positions are anchors.
2. Equal texts are folded first: one stays, and all of its bytes are known to be repeated.
3. An anchor whose leading ``CORE`` bytes occur at no other anchor has no repeated window.  The others' suffixes, with the
   bytes before them, are range-partitioned by their leading bytes with splitters from a sample.
4. A bucket sorts its suffixes, and the reversed stretches before them, by multikey quicksort, with the lengths of the
   common prefixes of neighbours.  For each offset o, the windows that begin o bytes before an anchor are equal where the
   left stretches agree in o bytes and the suffixes in ``LENGTH`` - o: both are runs of the sorted orders.  Splitters are
   compared by as many bytes as any pair has to share, so no pair of equal windows lies across a boundary.
5. Suffixes that begin with the same bytes more than ``HOT`` times would meet in one bucket; their windows are counted by
   digests instead, of which a batch sends each only once.
6. Runs of repeated windows become removed spans; the rest of the bytes is kept.

Defined cases: null and empty texts have no bytes and no spans; texts shorter than ``LENGTH`` lose nothing; repeated rows
are copies of each other and are removed whole if long enough; null or repeated ids are allowed, each row is a document of
its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chars
from tidemark.llm.common import bound_batches, keyed, stored

LENGTH = 400
CORE = 64
LEAD = 24
HOT = 4096
SAMPLES_PER_BUCKET = 40
FEW = 24  # ranges of at most so many suffixes are sorted by plain comparison
ANCHORS = "array<struct<core:bigint,at:int,low:int,high:int,lead:binary>>"
FRAGMENTS = "bucket int, key long, at int, low int, high int, left binary, right binary"
SPANS = "key long, first long, last long"


def anchors(data: bytes, length: int = LENGTH, core: int = CORE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors, the least and greatest offset of the windows they belong to, and hashes of their cores."""
    n, width = len(data), length - core + 1
    if n < length:
        return (np.empty(0, np.int64),) * 4
    eight = chars.grams(np.frombuffer(data, np.uint8), 8)[: n - core + 1]
    rank = (eight * np.uint64(0x9E3779B97F4A7C15)) ^ (eight >> np.uint64(31))
    rank = (rank * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    ranked = np.full(-(-len(rank) // width) * width, np.iinfo(np.uint64).max)
    ranked[: len(rank)] = rank << np.uint64(32) | np.arange(len(rank), dtype=np.uint64)
    blocks = ranked.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()  # least from here to the block's end
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    windows = n - length + 1
    anchor = (np.minimum(ahead[:windows], behind[width - 1 : width - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
    last = np.append(first[1:], windows) - 1
    at = anchor[first]
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,))
    cores = np.zeros(len(at), np.uint64)
    for k in range(0, core, 8):
        cores = (cores ^ words[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        cores ^= cores >> np.uint64(32)
    return at, at - last, at - first, cores.view(np.int64)


def multikey_quicksort(rows: list[bytes]) -> np.ndarray:
    """The order of ``rows``, partitioned by 8 bytes at a time around a pivot; equal parts go on with the next 8 bytes."""
    if not rows:
        return np.empty(0, np.int64)
    width = -(-max(map(len, rows)) // 8) + 1
    table = np.zeros((len(rows), width * 8), np.uint8)
    for i, row in enumerate(rows):
        table[i, : len(row)] = np.frombuffer(row, np.uint8)
    words = table.view(">u8").astype(np.uint64)
    order, pending = np.arange(len(rows)), [(0, len(rows), 0)]
    while pending:
        low, high, depth = pending.pop()
        part = order[low:high]
        if high - low <= FEW or depth == width:
            order[low:high] = sorted(part.tolist(), key=rows.__getitem__)
            continue
        key = words[part, depth]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[len(key[:: max(1, len(key) // 9)]) // 2]
        less, more = part[key < pivot], part[key > pivot]
        same = part[key == pivot]
        order[low:high] = np.concatenate([less, same, more])
        a, b = low + len(less), high - len(more)
        pending += [(x, y, d) for x, y, d in ((low, a, depth), (a, b, depth + 1), (b, high, depth)) if y - x > 1]
    return order


def common_prefixes(rows: list[bytes], order: np.ndarray) -> np.ndarray:
    """Entry i: how many bytes row ``order[i]`` shares with its predecessor; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    for i in range(1, len(order)):
        a, b = rows[order[i - 1]], rows[order[i]]
        most = min(len(a), len(b))
        if a[:most] == b[:most]:
            shared[i] = most
        elif a[:CORE] == b[:CORE]:
            x = np.frombuffer(a, np.uint8, most) != np.frombuffer(b, np.uint8, most)
            shared[i] = int(x.argmax())
        else:
            shared[i] = next((k for k in range(min(most, CORE)) if a[k] != b[k]), min(most, CORE))
    return shared


def repeated_windows(
    at: np.ndarray, low: np.ndarray, high: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH, core: int = CORE
) -> list[tuple[int, int, int]]:
    """(row, first, last): runs of starts of repeated windows among those that belong to the given anchors."""
    n = len(right)
    by_right = multikey_quicksort(right)
    shared = common_prefixes(right, by_right)
    group = np.empty(n, np.int64)
    group[by_right] = np.cumsum(shared < core)
    turned = [int(g).to_bytes(8, "big") + b[::-1] for g, b in zip(group, left)]
    by_left = multikey_quicksort(turned)
    shared_left = np.maximum(common_prefixes(turned, by_left) - 8, -1)
    same_group = np.append(False, group[by_left[1:]] == group[by_left[:-1]])
    shared_left[~same_group] = -1

    def reach(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        most = np.empty(n, np.int64)
        most[order] = np.maximum(lcp, np.append(lcp[1:], -1))
        return most

    left_reach, right_reach = reach(by_left, shared_left), reach(by_right, shared)
    maybe = np.flatnonzero(left_reach + right_reach >= length)
    low_, high_ = low[maybe], high[maybe]
    low_ = np.maximum(low_, length - right_reach[maybe])
    high_ = np.minimum(high_, left_reach[maybe])
    repeated = np.zeros((len(maybe), int(high_.max(initial=0)) + 2), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(low_.min(initial=0)), int(high_.max(initial=-1)) + 1):
        some = np.flatnonzero((low_ <= o) & (o <= high_))
        if len(some) < 2:
            continue
        right_class[by_right] = np.cumsum(shared < length - o)
        left_class[by_left] = np.cumsum(shared_left < o)
        who = maybe[some]
        _, inverse, count = np.unique(right_class[who] * (n + 1) + left_class[who], return_inverse=True, return_counts=True)
        repeated[some, o] = count[inverse] > 1
    edges = np.diff(np.pad(repeated, ((0, 0), (1, 0))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edges == 1)
    row_end, end = np.nonzero(edges == -1)
    return [(int(maybe[r]), int(at[maybe[r]] - e + 1), int(at[maybe[r]] - b)) for r, b, e in zip(row, begin, end)]


def spans(firsts: np.ndarray, lasts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under windows that begin at ``firsts`` to ``lasts``."""
    found: list[tuple[int, int]] = []
    for i in np.argsort(firsts, kind="stable"):
        begin, end = int(firsts[i]), int(lasts[i]) + length
        if found and begin <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((begin, end))
    return found


def _anchor_table(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, lists = [], []
            for key, data in zip(batch["key"], batch["data"]):
                at, low, high, core = anchors(data)
                # One core in 16 tells its leading bytes, of which the splitters are drawn.
                leads = [data[a : a + LEAD] if c & 15 == 0 else None for a, c in zip(at.tolist(), core.tolist())]
                keys.append(key)
                lists.append([
                    {"core": c, "at": a, "low": lo, "high": hi, "lead": x}
                    for c, a, lo, hi, x in zip(core.tolist(), at.tolist(), low.tolist(), high.tolist(), leads)
                ])
            yield pd.DataFrame({"key": keys, "anchors": lists})

    long = texts.filter(F.octet_length("text") >= LENGTH).select("key", F.col("text").cast("binary").alias("data"))
    return long.mapInPandas(run, f"key long, anchors {ANCHORS}")


def _fragments(rows: DataFrame, splitters: list[bytes]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for key, data, found in zip(batch["key"], batch["data"], batch["anchors"]):
                for a in found:
                    at, low, high = a["at"], a["low"], a["high"]
                    right = data[at : at + LENGTH - low]
                    out.append((bisect_right(splitters, right[:LEAD]), key, at, low, high, data[at - high : at], right))
                    held += len(right) + high
                if held > 4 << 20:
                    yield pd.DataFrame(out, columns=["bucket", "key", "at", "low", "high", "left", "right"])
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=["bucket", "key", "at", "low", "high", "left", "right"])

    return rows.mapInPandas(run, FRAGMENTS)


def _sort_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(batches)
    if parts:
        rows = pd.concat(parts, ignore_index=True)
        del parts
        found = repeated_windows(
            rows["at"].to_numpy(np.int64), rows["low"].to_numpy(np.int64), rows["high"].to_numpy(np.int64),
            rows["left"].tolist(), rows["right"].tolist(),
        )
        keys = rows["key"].to_numpy()
        yield pd.DataFrame([(keys[i], a, b) for i, a, b in found], columns=["key", "first", "last"])


def _window_runs(key: np.ndarray, first: np.ndarray) -> pd.DataFrame:
    """Runs of consecutive starts."""
    order = np.lexsort((first, key))
    key, first = key[order], first[order]
    begins = np.append(True, (key[1:] != key[:-1]) | (first[1:] != first[:-1] + 1))[: len(key)]
    ends = np.append(begins[1:], True)[: len(key)]
    return pd.DataFrame({"key": key[begins], "first": first[begins], "last": first[ends]})


def _counted_windows(rows: DataFrame, buckets: int) -> DataFrame:
    """Runs of repeated windows of the given anchors, by digests of all of them.

    Digests travel packed, one row for each batch and range of digests.  What repeats within a batch is known to be
    repeated and is sent once, marked, for the others' sake; so a bucket receives a digest once from each batch at most.
    """

    def scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests, keys, firsts = [], [], []
            for key, data, found in zip(batch["key"], batch["data"], batch["anchors"]):
                for a in found:
                    starts = np.arange(a["at"] - a["high"], a["at"] - a["low"] + 1)
                    view = memoryview(data)
                    digests += [hashlib.blake2b(view[s : s + LENGTH], digest_size=16).digest() for s in starts.tolist()]
                    keys.append(np.full(len(starts), key, np.int64))
                    firsts.append(starts)
            if not digests:
                continue
            digest = np.frombuffer(b"".join(digests), [("a", "<u8"), ("b", "<u8")])
            key, first = np.concatenate(keys), np.concatenate(firsts)
            order = np.lexsort((digest["b"], digest["a"]))
            digest, key, first = digest[order], key[order], first[order]
            new = np.append(True, digest[1:] != digest[:-1])
            several = ~(new & np.append(new[1:], True))
            runs = _window_runs(key[several], first[several])
            yield pd.DataFrame({
                "bucket": [buckets + int(key[0]) % buckets], "digests": [b""], "marks": [b""], "keys": [runs["key"].to_numpy().tobytes()],
                "firsts": [runs["first"].to_numpy().tobytes()], "lasts": [runs["last"].to_numpy().tobytes()],
            })
            digest, key, first, several = digest[new], key[new], first[new], several[new]
            bucket = ((digest["a"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            cols = [[x.tobytes() for x in np.split(c, cut)] for c in (digest, several, key, first)]
            yield pd.DataFrame({
                "bucket": bucket[np.append(0, cut)], "digests": cols[0], "marks": cols[1], "keys": cols[2], "firsts": cols[3],
                "lasts": b"",
            })

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = []
        for batch in batches:
            for bucket, d, m, k, f, last in batch.itertuples(index=False):
                key, first = np.frombuffer(k, np.int64), np.frombuffer(f, np.int64)
                if bucket >= buckets:
                    yield pd.DataFrame({"key": key, "first": first, "last": np.frombuffer(last, np.int64)})
                else:
                    parts.append((np.frombuffer(d, [("a", "<u8"), ("b", "<u8")]), np.frombuffer(m, bool), key, first))
        if parts:
            digest, mark, key, first = (np.concatenate(c) for c in zip(*parts))
            parts = None
            order = np.lexsort((digest["b"], digest["a"]))
            digest, mark, key, first = digest[order], mark[order], key[order], first[order]
            group = np.cumsum(np.append(True, digest[1:] != digest[:-1])) - 1
            repeated = (np.bincount(group) > 1) | (np.bincount(group, mark) > 0)
            # Marked rows were among the runs that their own batch has found.
            some = repeated[group] & ~mark
            yield _window_runs(key[some], first[some])

    packed = rows.mapInPandas(
        scatter, "bucket int, digests binary, marks binary, keys binary, firsts binary, lasts binary"
    )
    return packed.repartitionById(2 * buckets, "bucket").mapInPandas(gather, SPANS)


def repeated_runs(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``key, text``: the texts that stand for themselves and their copies (``key, copies``), and the runs of starts
    of repeated windows in them (``key, first, last``)."""
    spark = texts.sparkSession
    copies = stored(
        texts.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies")).drop("h"),
        "suffix-copies",
    )
    table = stored(_anchor_table(texts), "suffix-anchors")
    single = table.join(copies.select("key"), "key", "left_semi").select("key", F.explode("anchors").alias("a"))
    counts = single.groupBy(F.col("a.core").alias("core")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = stored(counts, "suffix-cores")
    live = stored(
        single.select("key", "a.*").join(counts, "core").select("key", "at", "low", "high", "lead", (F.col("n") > HOT).alias("hot")),
        "suffix-live",
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leads = live.filter("lead is not null and not hot").select("lead")
    share = min(1.0, SAMPLES_PER_BUCKET * buckets / max(1, leads.count()))
    sample = sorted(bytes(r.lead) for r in leads.sample(share, seed=7).collect())  # about SAMPLES_PER_BUCKET a bucket
    splitters = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []

    def with_text(part: DataFrame) -> DataFrame:
        lists = part.groupBy("key").agg(F.collect_list(F.struct("at", "low", "high")).alias("anchors"))
        data = texts.filter(F.octet_length("text") >= LENGTH).select("key", F.col("text").cast("binary").alias("data"))
        return data.join(lists, "key")

    fragments = _fragments(with_text(live.filter("not hot")), splitters)
    runs = fragments.repartitionById(len(splitters) + 1, "bucket").mapInPandas(_sort_buckets, SPANS)
    if not live.filter("hot").limit(1).isEmpty():
        runs = runs.unionByName(_counted_windows(with_text(live.filter("hot")), buckets))
    return copies, runs


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the kept bytes and removed spans of every row."""
    bound_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = keyed(base, "doc_id", ["doc_id", "text"])
    texts = base.select("key", "text")
    copies, runs = repeated_runs(texts)
    lists = runs.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    known = copies.join(lists, "key", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, no_id, data, whole, found in batch.itertuples(index=False):
                if whole and len(data) >= LENGTH:
                    gone = [(0, len(data))]
                elif found is None:
                    gone = []
                else:
                    gone = spans(np.array([r["first"] for r in found]), np.array([r["last"] for r in found]), LENGTH)
                at, kept = 0, []
                for begin, end in gone:
                    kept.append(data[at:begin])
                    at = end
                rest = b"".join([*kept, data[at:]])
                rows.append((
                    None if no_id else i, len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(),
                    rest, [{"begin": b, "end": e} for b, e in gone],
                ))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    joined = base.join(known, "key", "left").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
        F.col("text").cast("binary").alias("data"), (F.coalesce("copies", F.lit(2)) > 1).alias("whole"), "runs",
    )
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary,"
        " removed array<struct<begin:bigint,end:bigint>>"
    )
    return joined.mapInPandas(cut, schema)
