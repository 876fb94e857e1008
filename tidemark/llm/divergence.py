"""How a source's vocabulary differs from its language's and from other sources': iceberg prefix refinement, exact sums.

A term is a run of ASCII letters and characters beyond ASCII, A-Z lower-cased.  Each language keeps the terms that
``MIN_DOCS`` of its documents hold.

*Refinement.*  A term is its bytes and an end mark.  A prefix of ``LEVELS[0]`` bytes is held by at least as many documents
as any term behind it, so a prefix below the threshold is discarded with all its terms; what is left is refined to
prefixes twice as long, level by level, until every term left is complete.  Rare long terms are never shuffled whole.
Tasks fold the documents of an Arrow batch: a row holds how often a term occurs in each source of a language, in how many
documents, and for each level in how many of them it is the first of its prefix.  These counts add up, so no document is
compared again and distinct documents are counted by sums, partial ones first; a frequent term costs one row a batch.

*Divergence.*  All probabilities are integers scaled by ``SCALE``, computed in decimals.  Two sources differ by a sum
over all kept terms, most of which neither of them holds.  The sum is taken from the case where one of them holds none
(a histogram of the other's probabilities, one row per pair) and a correction for terms that both hold: tasks work
through terms in blocks of bounded size and send one sum for each pair and block.

Defined cases: null language, source and text are empty; repeated rows and ids are documents of their own; a group
without terms is a group; terms and texts may have any length; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, release_memory, stored

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Shorter prefixes are held by enough documents nearly always: a level of them discards nothing.
FIRST_LEVEL = 8
END = b"\x00"
#: Products that a task holds at a time when it compares the sources of its terms.
BLOCK = 1 << 20
#: Rows and bytes up to which a list of prefixes is broadcast; beyond, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
BUCKETS = 8

OCCURRENCES = "lang string, term binary, firsts array<long>, counts array<struct<source:string,n:bigint,docs:bigint>>"

_LETTER = np.zeros(256, bool)
_LETTER[128:] = _LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


# --- terms of documents ----------------------------------------------------------------------------------------------


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The document of each term, and all terms."""
    texts = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    if texts.offset:
        texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8, offsets[-1]) if data is not None else np.empty(0, np.uint8)
    letter = _LETTER[raw]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    at = offsets[:-1]
    at = at[at < len(raw)]
    opens[at] = letter[at]  # no term crosses documents
    starts = np.flatnonzero(opens)
    kept = np.concatenate([[0], np.cumsum(letter)])
    bounds = np.append(kept[starts], kept[-1]).astype(np.int64)
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw[letter])])
    return np.searchsorted(offsets, starts, "right") - 1, terms


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and for each the sum of every value."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]


def _levels(longest: int) -> list[int]:
    """Prefix lengths up to one that holds the longest term and its end mark."""
    levels = [FIRST_LEVEL]
    while levels[-1] < longest + 1:
        levels.append(2 * levels[-1])
    return levels


def _ranges(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold a batch of (lang, source, text): a row for each term of a language, and one without a term for each language."""
    for batch in batches:
        (lang_of, langs), (source_of, sources) = (
            (c.indices.to_numpy().astype(np.int64), c.dictionary.cast(pa.string()))
            for c in (pc.fill_null(batch.column(k), "").dictionary_encode() for k in (0, 1))
        )
        doc, terms = _terms(batch.column(2))
        coded = terms.dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        words = pc.binary_join_element_wise(coded.dictionary.take(order), pa.scalar(END, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        size = max(1, len(words))
        held, n = _sums(doc * size + rank[coded.indices.to_numpy()], np.ones(len(doc), np.int64))  # a document's terms in order
        doc, code = np.divmod(held, size)
        lengths = pc.binary_length(words).to_numpy()
        levels = _levels(int(lengths.max(initial=1)) - 1)
        flags = []
        for level in levels:
            prefix = pc.binary_slice(words, 0, level).dictionary_encode().indices.to_numpy()[code]
            flags.append(np.append(True, (doc[1:] != doc[:-1]) | (prefix[1:] != prefix[:-1]))[: len(doc)].astype(np.int64))
        ones = np.ones(len(code), np.int64)
        by_lang, docs, *flags = _sums(lang_of[doc] * size + code, ones, *flags)
        by_source, n, own = _sums((lang_of[doc] * size + code) * len(sources) + source_of[doc], n, ones)
        counts = pa.StructArray.from_arrays(
            [sources.take(pa.array(by_source % max(1, len(sources)))), pa.array(n), pa.array(own)], ["source", "n", "docs"]
        )
        which, code = np.divmod(by_lang, size)
        needed = np.searchsorted(levels, lengths[code]) + 1
        table = np.stack(flags, 1) if len(by_lang) else np.empty((0, len(levels)), np.int64)
        firsts = table[np.arange(len(levels)) < needed[:, None]]
        found = pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(which)),
                words.take(pa.array(code)).cast(pa.binary()),
                pa.ListArray.from_arrays(np.append(0, np.cumsum(needed)).astype(np.int32), firsts),
                pa.ListArray.from_arrays(_ranges(by_source // max(1, len(sources))).astype(np.int32), counts),
            ],
            ["lang", "term", "firsts", "counts"],
        )
        yield found
        # Groups without terms are groups.
        pairs = np.unique(lang_of * max(1, len(sources)) + source_of)
        own = np.zeros(len(pairs), np.int64)
        here = pa.StructArray.from_arrays([sources.take(pa.array(pairs % max(1, len(sources)))), pa.array(own), pa.array(own)], ["source", "n", "docs"])
        bounds = _ranges(pairs // max(1, len(sources)))
        none = pa.nulls(len(bounds) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(pairs[bounds[:-1]] // max(1, len(sources)))),
                none.cast(pa.binary()),
                none.cast(found.schema.field("firsts").type),
                pa.ListArray.from_arrays(bounds.astype(np.int32), here),
            ],
            found.schema.names,
        )
        release_memory()


# --- refinement ------------------------------------------------------------------------------------------------------


def _among(rows: DataFrame, key: Column, listed: DataFrame) -> DataFrame:
    """Rows whose (lang, key) is listed as (l, k).  The list is broadcast if it was counted to be small."""
    n, size = listed.agg(F.count("*"), F.sum(F.octet_length("k") + F.octet_length(F.col("l").cast("binary")))).head()
    if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return rows.join(listed, (rows["lang"] == listed["l"]) & (key == listed["k"]), "left_semi")


def _complete(rows: DataFrame, min_docs: int) -> DataFrame:
    """Counts of the terms that enough documents hold, by source; ``lang_n`` in the language, ``first`` on one row a term."""
    of_term = Window.partitionBy("lang", "term")
    # One shuffle, of folded rows: sums by source and over sources are both taken where a term's rows are.
    single = rows.repartition("lang", "term").select("lang", "term", F.inline("counts"))
    counts = single.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = counts.withColumns(
        {
            "all_docs": F.sum("docs").over(of_term),
            "lang_n": F.sum("n").over(of_term),
            "first": F.col("source") == F.min("source").over(of_term),
        }
    )
    return held.filter(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first")


def kept_terms(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): the kept terms of each language, each with its end mark, and their counts."""
    live = occurrences.filter("term is not null")
    longest = live.agg(F.max(F.octet_length("term"))).head()[0] or 1
    found = []
    for i, level in enumerate(_levels(longest - 1)):
        length, prefix = F.octet_length("term"), F.substring("term", 1, level)
        found.append(_complete(live.filter(length <= level), min_docs))
        longer = live.filter(length > level)
        counted = longer.groupBy(F.col("lang").alias("l"), prefix.alias("k")).agg(F.sum(F.col("firsts")[i]).alias("docs"))
        left = stored(counted.filter(F.col("docs") >= min_docs).select("l", "k"), "prefixes")
        if left.isEmpty():
            break
        # A prefix that is left has only such parents, so looking it up is looking up all of them.
        live = _among(occurrences.filter(length > level), prefix, left)
    return reduce(DataFrame.union, found)


# --- divergence ------------------------------------------------------------------------------------------------------


def _p(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact; null without terms.  Decimals only where a long is too short."""
    below = F.nullif(total + terms, F.lit(0))
    wide = (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    above = (n + 1) * F.lit(SCALE).cast("long")
    exact = F.call_function("div", wide, below.cast("decimal(20,0)"))
    return F.when(n < 9 * SCALE, F.call_function("div", above, below)).otherwise(exact) + 1


def _f(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); up to 10 ** 18, so it fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (lang, sources: struct of source, p and p without occurrences): corrections for terms both sources hold."""
    f = lambda p, q: (p - q) ** 2 // q
    for batch in batches:
        lists = batch.column(1)
        offsets = lists.offsets.to_numpy()
        inner = lists.values
        names = inner.field("source").dictionary_encode()
        code, p, zero = names.indices.to_numpy().astype(np.int64), inner.field("p").to_numpy(), inner.field("zero").to_numpy()
        lang = batch.column(0).dictionary_encode()
        of, size = lang.indices.to_numpy().astype(np.int64), len(names.dictionary)
        keys, values, held = [], [], 0

        def flush():
            k, v = _sums(np.concatenate(keys), np.concatenate(values))
            which, pair = np.divmod(k, size * size)
            a, b = np.divmod(pair, size)
            take = lambda d, i: d.dictionary.take(pa.array(i)).cast(pa.string())
            return pa.RecordBatch.from_arrays([take(lang, which), take(names, a), take(names, b), pa.array(v)], ["lang", "source", "other", "value"])

        # Terms that equally many sources hold are compared at once.
        for k in np.unique(np.diff(offsets)):
            rows = np.flatnonzero(np.diff(offsets) == k)
            many, few = max(1, BLOCK // (k * k)), min(k, max(1, BLOCK // k))
            for begin in range(0, len(rows), many):
                part = rows[begin : begin + many]
                all_ = offsets[part][:, None] + np.arange(k)
                for start in range(0, k, few):
                    mine = all_[:, start : start + few, None]
                    theirs = all_[:, None, :]
                    ps, p0, qs, q0 = p[mine], zero[mine], p[theirs], zero[theirs]
                    values.append((f(ps, qs) - f(ps, q0) - f(p0, qs) + f(p0, q0)).ravel())
                    keys.append(((of[part][:, None, None] * size + code[mine]) * size + code[theirs]).ravel())
                    held += len(keys[-1])
                    if held >= BLOCK:
                        yield flush()
                        keys, values, held = [], [], 0
        if keys:
            yield flush()
        release_memory()


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, from ``counts`` (.., p) and ``groups`` (.., zero, terms)."""
    sources = F.collect_list(F.struct("source", "p", "zero")).alias("sources")
    held = counts.groupBy("lang", "term").agg(sources).filter(F.size("sources") > 1).select("lang", "sources")
    both = held.mapInArrow(_compare, "lang string, source string, other string, value long")
    histogram = counts.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    histogram = histogram.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("histogram"))
    mine = groups.join(histogram, ["lang", "source"], "left")
    # A language may hold most of the groups: its pairs are dealt out by the first one.
    mine = mine.withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(BUCKETS)))
    other = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    other = other.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BUCKETS - 1).cast("long"))))
    pairs = mine.join(other, ["lang", "bucket"]).filter(F.col("source") != F.col("other"))

    def summed(of) -> Column:
        return F.aggregate(F.coalesce("histogram", F.array().cast("array<struct<p:bigint,n:bigint>>")), F.lit(0).cast("long"), lambda s, h: s + h["n"] * of(h["p"]))

    p0, q0 = F.col("zero"), F.col("other_zero")
    own = F.coalesce(F.col("terms") * _f(p0, q0), F.lit(0).cast("long")) + summed(lambda p: _f(p, q0) - _f(p0, q0))
    reverse = summed(lambda q: _f(q0, q) - _f(q0, p0))
    rows = pairs.select(
        "lang", F.inline(F.array(
            F.struct("source", "other", own.alias("value")),
            F.struct(F.col("other").alias("source"), F.col("source").alias("other"), reverse.alias("value")),
        ))
    )
    both = both.filter(F.col("source") != F.col("other"))
    summed_up = rows.unionByName(both).groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    return summed_up.withColumn("part", F.lit("pair"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for every group the other sources (pair) and its most typical terms (term)."""
    bound_batches(docs.sparkSession)
    occurrences = stored(docs.select("lang", "source", "text").mapInArrow(_count_terms, OCCURRENCES), "occurrences")
    groups = occurrences.filter("term is null").select("lang", F.inline("counts")).select("lang", "source").distinct()
    kept = stored(kept_terms(occurrences, min_docs), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("own_terms"))
    groups = stored(groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total", "own_terms"]), "groups")
    langs = groups.groupBy("lang").agg(F.sum("own_terms").alias("terms"), F.sum("total").alias("lang_total"))
    groups = groups.join(langs, "lang").withColumn("zero", _p(F.lit(0), F.col("total"), F.col("terms")))
    groups = stored(groups.select("lang", "source", "total", "terms", "lang_total", "zero"), "groups")

    counts = kept.join(groups, ["lang", "source"]).withColumns(
        {"p": _p(F.col("n"), F.col("total"), F.col("terms")), "q": _p(F.col("lang_n"), F.col("lang_total"), F.col("terms"))}
    )
    pairs = _pairs(counts, groups)
    text = F.decode(F.substring("term", 1, F.octet_length("term") - 1), "UTF-8")
    terms = counts.filter("p > q").select("lang", "source", text.alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(w))]
    ranked.append(terms.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_terms))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked[0].select(*columns).union(ranked[1].select(*columns))
