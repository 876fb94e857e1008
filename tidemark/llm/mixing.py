"""Mix sources to target weights: a min-cost flow over membership patterns, then a seeded choice of documents.

A document may belong to several sources.  Documents are aggregated by membership pattern (the set of their sources);
a pattern offers its words once for nothing, again at a higher price, and so on (convex repetition costs), and every
source asks for its quota.  The flow of least cost says how many words each source takes from each pattern.  The graph
has one node per pattern and per source, however many documents there are.

What the flow routes through a pattern is some whole passes over its documents and a rest; the rest goes to those with
the smallest seeded hash.  The hash where it ends is found by histograms of the hash, refined three times, so that
nothing is sorted and a hot source is summed in parallel.  What is then left is filled in further rounds with documents
behind that hash which are no larger.  In the end one more document is taken if that comes nearer: a pattern misses its
words by at most half of the smallest document (or group of equal rows) that was not taken.

Defined cases: null texts have size 0; a null source is a source of its own, ordered last; a document without any source
(empty or null array) is never taken; repeated rows and equal ids are judged by a hash of id and text, so equal rows are
taken together; an empty table gives no rows.  Other columns are kept and may have any name.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, stored, words

EPOCHS = 3
WEIGHTS = (5, 2, 1)
STEP_BITS, STEPS = 10, 3
#: Each round asks for less; what a last one would still leave is bounded by the document that is nearest to it.
ROUNDS = 12
#: The flow is solved on the driver; more patterns than this are refused, never dropped.
MAX_PATTERNS = 20_000
SPANS = "array<struct<begin:bigint,end:bigint,most:bigint>>"
SOURCES = "array<struct<source:string,source_size:bigint,target:double>>"


def targets(sizes: dict, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> dict:
    """Shares of the sum of ``sizes`` by repeating weights in code-point order (null last), none above its cap.

    What a source cannot take is shared by weight among those below their caps, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, found = Fraction(sum(sizes.values())), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not above:
            return found | share
        for s in above:
            found[s] = Fraction(epochs * sizes[s])
            left -= found[s]
        open_ = [s for s in open_ if s not in above]
    return found


def min_cost_flow(capacity: dict, quota: dict, epochs: int = EPOCHS) -> dict:
    """Words by (pattern, source): successive cheapest augmenting paths with node potentials.

    ``capacity`` maps a pattern (tuple of sources) to its words, offered ``epochs`` times at costs 0, 1, 3, 6 ...
    """
    sources, patterns = list(quota), list(capacity)
    node = {("s", s): i for i, s in enumerate(sources)} | {("p", p): len(sources) + i for i, p in enumerate(patterns)}
    start, end = len(node), len(node) + 1
    edges, leaving = [], [[] for _ in range(len(node) + 2)]

    def add(a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            leaving[x].append(len(edges))
            edges.append([y, r, c])
        return len(edges) - 2

    taken = {}
    for p in patterns:
        for e in range(epochs):
            add(start, node["p", p], capacity[p], e * (e + 1) // 2)
        for s in p:
            if s in quota:
                taken[p, s] = add(node["p", p], node["s", s], epochs * capacity[p], 0)
    for s in sources:
        add(node["s", s], end, quota[s], 0)
    potential = [0] * len(leaving)
    while True:
        far, via, heap = [None] * len(leaving), [None] * len(leaving), [(0, start)]
        far[start] = 0
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k in leaving[a]:
                b, room, cost = edges[k]
                if room > 0 and (far[b] is None or d + cost + potential[a] - potential[b] < far[b]):
                    far[b], via[b] = d + cost + potential[a] - potential[b], k
                    heapq.heappush(heap, (far[b], b))
        if far[end] is None:
            return {key: edges[k ^ 1][1] for key, k in taken.items() if edges[k ^ 1][1]}
        potential = [p + (f if f is not None else far[end]) for p, f in zip(potential, far)]
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        push = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= push
            edges[k ^ 1][1] += push


def _hash(seed: int, *columns: Column) -> Column:
    bits = STEP_BITS * STEPS
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - bits)


def _locate(lines: DataFrame, marks: dict) -> dict:
    """For every pattern and its (first hash, words) in ``marks``, where documents from there on that hold as many words end.

    Documents of more words are passed over.  Found are the hash that no longer fits, the words before it and its own,
    which are 0 if there is none.
    """
    spark, bits = lines.sparkSession, STEP_BITS * STEPS
    state = {p: (0, 0, 0) for p in marks}  # prefix of the hash, words before it, words of it
    found = {}
    for step in range(1, STEPS + 1):
        if not state:
            break
        shift = bits - STEP_BITS * step
        order = list(state)
        wanted = spark.createDataFrame(
            [(list(p), i, state[p][0], *marks[p]) for i, p in enumerate(order)],
            "w array<string>, i int, q long, begin long, most long",
        )
        sums = (
            lines.join(
                F.broadcast(wanted),  # at most one row for each pattern, bounded by MAX_PATTERNS
                F.col("w").eqNullSafe(F.col("pattern")) & (F.shiftright("hash", shift + STEP_BITS) == F.col("q")),
            )
            .filter("hash >= begin AND size <= most AND size > 0")
            .groupBy("i", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("n"))
        )
        by_pattern: dict[int, list] = {}
        for row in sums.collect():  # 2 ** STEP_BITS rows for each pattern at most
            by_pattern.setdefault(row.i, []).append((row.bucket, row.n))
        for i, p in enumerate(order):
            before = state[p][1]
            for bucket, n in sorted(by_pattern.get(i, [])):
                if before + n > marks[p][1]:
                    state[p] = (bucket, before, n)
                    break
                before += n
            else:  # only in the first step: all fit
                found[p] = (1 << bits, before, 0)
                del state[p]
    return found | state


def _choose(lines: DataFrame, rests: dict) -> dict:
    """For each pattern, spans (first hash, end, largest size) of the documents that together come near its rest."""
    spans: dict = {p: [] for p in rests}
    left, open_ = dict(rests), {p: (0, rest) for p, rest in rests.items()}
    for _ in range(ROUNDS):
        if not open_:
            break
        for p, (at, before, over) in _locate(lines, open_).items():
            begin, most = open_.pop(p)
            left[p] -= before
            if before:
                spans[p].append((begin, at, most))
            if over and left[p]:
                open_[p] = (at + 1, left[p])
    for p, found in _nearest(lines, {p: n for p, n in left.items() if n}, spans).items():
        spans[p].append(found)
    return spans


def _nearest(lines: DataFrame, left: dict, spans: dict) -> dict:
    """For patterns where one more hash leaves less error than ``left``, the span of the best one."""
    if not left:
        return {}
    order = list(left)
    wanted = lines.sparkSession.createDataFrame(
        [(list(p), i, left[p], spans[p]) for i, p in enumerate(order)], f"w array<string>, i int, left long, spans {SPANS}"
    )
    rest = lines.join(F.broadcast(wanted), F.col("w").eqNullSafe(F.col("pattern")))  # one row per pattern
    rest = rest.filter("size > 0 AND size < 2 * left AND NOT exists(spans, s -> hash >= s.begin AND hash < s.end AND size <= s.most)")
    sums = rest.groupBy("i", "hash", "left").agg(F.sum("size").alias("n")).filter("n < 2 * left")
    best = sums.groupBy("i").agg(F.expr("min(struct(abs(n - left), hash)).hash").alias("hash"))
    return {order[r.i]: (r.hash, r.hash + 1, 2 * left[order[r.i]] - 1) for r in best.collect()}


def mix(
    docs: DataFrame, members: Column, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``mix!``: size, taken, and size and target of its sources.

    ``members`` is an array of source names; the order and repetition of its elements do not matter.
    """
    spark = docs.sparkSession
    size = F.size(words(F.col(text_col))).cast("long")
    pattern = F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>"))))
    lines = stored(  # three numbers a row; the histograms read them several times
        docs.select(
            pattern.alias("pattern"), size.alias("size"), _hash(seed, F.col(id_col), F.col(text_col)).alias("hash")
        ),
        "mixing",
    )
    totals = lines.groupBy("pattern").agg(F.sum("size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity = {tuple(row.pattern): row.n for row in totals}
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    asked = targets(sizes, weights, epochs)
    flow = min_cost_flow({p: n for p, n in capacity.items() if p}, {s: int(t) for s, t in asked.items()}, epochs)

    routed = {p: sum(n for (q, _), n in flow.items() if q == p) for p in capacity}
    full = {p: divmod(n, capacity[p]) if capacity[p] else (0, 0) for p, n in routed.items()}
    spans = _choose(lines, {p: rest for p, (_, rest) in full.items() if rest})
    rows = [
        (list(p), turns, spans.get(p, []), [(s, int(sizes[s]), float(asked[s])) for s in p])
        for p, (turns, _) in full.items()
    ]
    plan = spark.createDataFrame(rows, f"`w!` array<string>, `turns!` long, `spans!` {SPANS}, `sources!` {SOURCES}")
    joined = docs.withColumn("pattern!", pattern).join(
        F.broadcast(plan), F.col("`pattern!`").eqNullSafe(F.col("`w!`"))  # one row per pattern
    )

    def judged(line: Column) -> Column:
        n, h = line["size"], line["hash"]
        more = F.exists("spans!", lambda s: (h >= s["begin"]) & (h < s["end"]) & (n <= s["most"])).cast("long")
        return F.struct(n.alias("size"), (n * (F.col("`turns!`") + more)).alias("taken"))

    line = F.struct(size.alias("size"), _hash(seed, F.col(id_col), F.col(text_col)).alias("hash"))
    taken = let(line, judged)
    return joined.withColumn("mix!", taken.withField("sources", F.col("`sources!`"))).drop(
        "pattern!", "w!", "turns!", "spans!", "sources!"
    )
