"""One query per operator over the test tables, with production parameters, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chain_dedup,
    chat,
    decontaminate,
    divergence,
    jaccard_join,
    merkle,
    mixing,
    quality_rules,
    records,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from tidemark.llm.common import table

END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.measure(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return measured.select("doc_id", *[F.col(f"`quality!`.{n}").alias(n) for n in names])


def _rules_sql() -> str:
    parts = ["NOT base_failed"]
    for r in quality_rules.RULES:
        if r.low is not None:
            parts.append(f"({r.denominator} = 0 OR {r.numerator} >= CAST({r.low} AS DOUBLE) * {r.denominator})")
        if r.high is not None:
            parts.append(f"({r.denominator} = 0 OR {r.numerator} <= CAST({r.high} AS DOUBLE) * {r.denominator})")
    return " AND ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for group in quality_rules.STOP_WORDS.values() for w in group}))
QUALITY_SQL = rf"""
WITH split AS (
  SELECT *, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i + 1 : i + 8] AS grams
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 7, 0))) AS i FROM split)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, grams) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, i + k AS at FROM repeated, (SELECT unnest(range(0, 8)) AS k)) GROUP BY doc_id),
measured AS (
  SELECT s.*, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(ws, lambda w: lower(w) IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(ws, lambda w, i: i > 1 AND w = ws[i - 1])) AS BIGINT) AS n_echo_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
judged AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM measured),
quality AS (SELECT *, ({_rules_sql()}) AS kept FROM judged)
"""
ORACLES["op1_quality_rules"] = QUALITY_SQL + (
    "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM quality"
)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLES["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS m
            FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
repeated AS (SELECT doc_id, i FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER w + 400 THEN 0 ELSE 1 END AS fresh
           FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, min(i) AS b, max(i) + 400 AS e FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, coalesce(lag(e) OVER w, 0) AS b, b AS e FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY b)
         UNION ALL SELECT d.doc_id, coalesce(max(s.e), 0), d.n FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id, d.n),
kept AS (SELECT d.doc_id, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS h
         FROM d JOIN gaps USING (doc_id) GROUP BY d.doc_id),
removed AS (SELECT doc_id, sum(e - b) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(r.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.shared_passages(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read(archive).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op5_warc"] = """
WITH hashed AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                       coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM hashed)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS INTEGER) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 5], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(0, CASE WHEN len(ws) > 0 THEN greatest(len(ws) - 4, 1) ELSE 0 END)) AS i FROM split)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.write(
        table(spark, sf_dir, "documents"), records.folder(spark), tokenizer_path("word_bpe_49k.json"), END_ID
    )
    return records.digests(index)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))
    return mixed.select(
        "doc_id",
        F.col("`mix!`.size").alias("size"),
        F.col("`mix!`.sources")[0].source_size.alias("source_size"),
        F.col("`mix!`.sources")[0].target.alias("target"),
        F.col("`mix!`.taken").alias("taken"),
    )


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(merkle.build(table(spark, sf_dir, "documents"), merkle.tampered_leaf())).drop("source")


def _merkle_levels(name: str, group: str, levels: int) -> str:
    """SQL for the levels above ``{name}0`` (group, pos, d, n) and each node's siblings at each of them."""
    parts = []
    for k in range(levels + 1):
        parts.append(f"""{name}s{k} AS (SELECT {group}, pos, n,
  CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
  CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
  FROM {name}{k} WINDOW w AS (PARTITION BY {group}, pos // 16 ORDER BY pos))""")
        parts.append(f"""{name}{k + 1} AS (SELECT {group}, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
  FROM {name}{k} GROUP BY {group}, pos // 16)""")
    return ",\n".join(parts)


def _merkle_folds(levels: int, upper: int) -> str:
    """SQL that folds each leaf through its source's levels and then the upper ones."""
    parts, previous = [], "f"
    for tree, group, at, count in (("t", "g", "pos", levels), ("u", "z", "spos", upper)):
        for k in range(count + 1):
            name = f"f{tree}{k}"
            parts.append(f"""{name} AS (SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.l || f.cur || s.r) ELSE f.cur END AS cur,
  f.proof || s.l || s.r AS proof) FROM {previous} f JOIN {tree}s{k} s ON s.{group} = f.{group} AND s.pos = f.{at} // {16**k})""")
            previous = name
    return ",\n".join(parts)


def _merkle_field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_FIELDS = " || ".join(map(_merkle_field, ("doc_id", "source", "lang", "n_chars")))
_LOWERED = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
_LEVELS, _UPPER = 7, 3  # enough for 16 ** 8 documents of a source and 16 ** 4 sources
# Unsigned crc32 of a decimal, a digit at a time; DuckDB has no such function.
_CRC_BITS = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {})"


def _crc_step(value: str, times: int) -> str:
    return value if times == 0 else (
        f"list_extract(list_transform([{_crc_step(value, times - 1)}], lambda x: {_CRC_BITS}), 1)"
    )


ORACLES["op11_merkle"] = f"""
WITH hashed AS (
  SELECT doc_id, coalesce('s' || source, '') AS g, sha256({_FIELDS} || {_merkle_field("text")}) AS leaf,
         sha256({_FIELDS} || {_merkle_field(_LOWERED)}) AS lowered,
         xor({_CRC.format(_crc_step("xor(a, b)", 8))}, 4294967295::BIGINT) % 5 = 0 AS tampered
  FROM documents),
t0 AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM hashed),
{_merkle_levels("t", "g", _LEVELS)},
u0 AS (SELECT 0 AS z, g, d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t{_LEVELS + 1}),
{_merkle_levels("u", "z", _UPPER)},
f AS (SELECT t.doc_id, t.g, t.pos, t.leaf, u.z, u.pos AS spos, u.d AS subroot, CASE WHEN t.tampered THEN t.lowered ELSE t.leaf END AS cur,
             '' AS proof FROM t0 t JOIN u0 u USING (g)),
{_merkle_folds(_LEVELS, _UPPER)}
SELECT doc_id, leaf, subroot, (SELECT d FROM u{_UPPER + 1}) AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
       cur = (SELECT d FROM u{_UPPER + 1}) AS verified FROM fu{_UPPER}
"""


SAMPLE_TALK = (-7, "\\### Assistant: </turn> ok")


@query
def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, said = SAMPLE_TALK
    rows = [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)]
    return chat.digests(chat.write(talks.union(spark.createDataFrame(rows, talks.schema))))


ORACLES["op12_chat"] = rf"""
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {SAMPLE_TALK[0]}, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{SAMPLE_TALK[1]}' FROM range(2) t(i)),
bodies AS (SELECT *, CASE WHEN regexp_matches(text, '(?s)\\.|### |</turn>')
                          THEN replace(replace(replace(text, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>') ELSE text END AS body
           FROM talks)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || role || ': ' || body || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM bodies GROUP BY conv_id
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def _share(n: str, total: str) -> str:
    return f"CAST(1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + v) AS BIGINT)"


ORACLES["op13_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.LOWER}') AS t FROM documents),
said AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM said GROUP BY ALL HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM kept GROUP BY lang),
c AS (SELECT s.lang, s.source, s.term, count(*) AS n FROM said s JOIN kept k ON k.lang = s.lang AND k.term = s.term GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(t.n, 0) AS total, coalesce(l.v, 0) AS v, l.lt
           FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l ON l.lang = g.lang
           LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) t ON t.lang = g.lang AND t.source = g.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_share("coalesce(c.n, 0)", "g.total")} AS p, {_share("k.ln", "g.lt")} AS q
      FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
found AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, CAST(coalesce(any_value(x.value), 0) AS BIGINT) AS value
  FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS other, sum(((a.p - b.p)::HUGEINT * (a.p - b.p)) // b.p) AS value
             FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term GROUP BY ALL) x
    ON x.lang = g.lang AND x.source = g.source AND x.other = o.source GROUP BY g.lang, g.source, o.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q)::HUGEINT * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""
