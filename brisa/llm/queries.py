"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from brisa.llm import bpe, langid, mixing, packing, quality, runs, shards, simhash, suffixes, tokens, turns, warc, winnow
from brisa.llm.text import n_bytes, settled, word_count
from brisa.queries.registry import query
from brisa.session import scratch_path


def _read(spark, sf_dir, table="documents"):
    return settled(spark).read.parquet(f"{sf_dir}/{table}.parquet")


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    docs = _read(spark, sf_dir)
    counted = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.over_limit(counted, 4096).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op8_sharding")
def op8_sharding(spark, sf_dir):
    docs = _read(spark, sf_dir).select(
        "doc_id",
        (n_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
    )
    dealt = shards.assign(docs, ["doc_id", "text_crc32"], "size", 8)
    return dealt.withColumn("grown_shard", F.lit(None).cast("int"))


_OP9_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS o
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
    FROM d GROUP BY source),
-- Rounds of the sharing: l is what one unit of weight gets, over all who still share.
f(round, l) AS (
    SELECT 0, (SELECT 1.5 * sum(source_size) / sum(w) FROM s)
    UNION ALL
    SELECT round + 1, (
        SELECT (1.5 * (SELECT sum(source_size) FROM s)
                - coalesce(sum(2.0 * source_size) FILTER (w * l > 2 * source_size), 0))
            / sum(w) FILTER (w * l <= 2 * source_size) FROM s)
    FROM f WHERE round < 200 AND l IS NOT NULL),
t AS (
    SELECT source, source_size, least(2.0 * source_size, w * (SELECT max(l) FROM f)) AS target FROM s),
p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS goal,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size
            ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
    (CASE WHEN source_size = 0 THEN 0 ELSE (goal // source_size) * size
        + greatest(0, least(size, goal % source_size - start)) END)::BIGINT AS taken
FROM p
"""


@query("op9_mixing", _OP9_SQL)
def op9_mixing(spark, sf_dir):
    return mixing.taken_words(mixing.mix(_read(spark, sf_dir)))


_OP5_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex,
        min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1)::INT,
        1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


@query("op5_warc", _OP5_SQL)
def op5_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(_read(spark, sf_dir, "pages")), path)
    found = warc.read_warc(spark, path)
    return found.select(
        warc.page_key("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_key("refers_to").alias("refers_to"),
    )


@query("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    return winnow.edit_likeness(_read(spark, sf_dir))


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir).select("doc_id", "text", "lang")
    return langid.identify_held_out(docs).select("doc_id", "held_out", "lang_pred", "score")


def _op1_sql() -> str:
    """Figures, votes and the EM rounds as a recursive query over the vote patterns."""
    word, n = r"[^\x20\x09-\x0D]+", "n_words"
    share = "coalesce({0} * 1.0e0 / nullif({1}, 0), 0)".format

    def vote(drop: str, keep: str) -> str:
        return f"CASE WHEN {drop} THEN -1 WHEN {keep} THEN 1 ELSE 0 END"

    ends, length = share("n_ends", n), share("word_chars", n)
    votes = [
        vote(f"{share('n_symbols', n)} > 0.3", f"{share('n_symbols', n)} <= 0.01"),
        vote(f"{share('n_letters', 'word_chars')} < 0.7", f"{share('n_letters', 'word_chars')} >= 0.85"),
        vote(f"{share('n_upper', 'n_letters')} > 0.4", f"{share('n_upper', 'n_letters')} < 0.15"),
        vote(f"{share('n_real', n)} < 0.8", f"{share('n_real', n)} >= 0.98"),
        vote(f"{share('n_repeat_words', n)} > 0.2", f"{share('n_repeat_words', n)} <= 0.02"),
        vote(f"{share('n_stutter', n)} > 0.2", f"{share('n_stutter', n)} <= 0.02"),
        vote(f"{share('n_dup_lines', 'n_lines')} > 0.3", "n_dup_lines = 0"),
        vote(f"n_words >= 40 AND ({ends} > 0.5 OR {ends} < 0.005)", f"{ends} BETWEEN 0.01 AND 0.3"),
        vote(f"n_words > 0 AND ({length} > 14 OR {length} < 2)", f"{length} BETWEEN 3 AND 9"),
    ]
    rules, p = len(votes), quality.PSEUDO

    def odds(prior: str, good: str, bad: str) -> str:
        each = " + ".join(
            f"CASE v[{j}] WHEN 0 THEN 0 WHEN -1 THEN ln({good}[{2 * j - 1}]) - ln({bad}[{2 * j - 1}]) "
            f"ELSE ln({good}[{2 * j}]) - ln({bad}[{2 * j}]) END"
            for j in range(1, rules + 1)
        )
        return f"1 / (1 + exp(-(ln({prior}) - ln(1 - {prior}) + {each})))"

    def chances(weight: str, guess: tuple[float, float]) -> str:
        def chance(j: int, k: int) -> str:
            own = f"coalesce(sum({weight}) FILTER (v[{j}] = {2 * k - 1}), 0)"
            cast = f"coalesce(sum({weight}) FILTER (v[{j}] <> 0), 0)"
            bounded = f"greatest(({own} + {p} * {guess[k]}e0) / ({cast} + {p}), {quality.RAREST}e0)"
            return f"least({bounded}, 1 - {quality.RAREST}e0)"

        return "[" + ", ".join(chance(j, k) for j in range(1, rules + 1) for k in (0, 1)) + "]"

    start = [list(g) * rules for g in (quality.GUESS_GOOD, quality.GUESS_BAD)]
    first = ", ".join("CAST([" + ", ".join(f"{x}e0" for x in g) + "] AS DOUBLE[])" for g in start)
    return rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
x AS (SELECT doc_id, i, w[i : i + 7] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (SELECT doc_id, i FROM x QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
r AS (
    SELECT doc_id, sum(step) AS n FROM (
        SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS step FROM again)
    GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '{word}')) AS l FROM d),
f AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        len(l) AS n_lines, len(regexp_extract_all(t, '\p{{L}}')) AS n_letters, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
        len(list_filter(w, lambda y: regexp_matches(y, '[\p{{L}}\p{{N}}]'))) AS n_real,
        len(list_filter(w, lambda y, i: y = w[i + 1])) AS n_stutter,
        len(list_filter(w, lambda y: regexp_matches(y, '[.?!]["'')\]]*$'))) AS n_ends
    FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [{", ".join(votes)}] AS v FROM f),
patterns AS (SELECT v, count(*) AS n FROM b GROUP BY v),
em(round, prior, good, bad) AS (
    SELECT 0, {quality.START}e0, {first}
    UNION ALL
    SELECT round + 1, (sum(g) + {p * quality.START}) / (sum(n) + {p}),
        {chances("g", quality.GUESS_GOOD)}, {chances("(n - g)", quality.GUESS_BAD)}
    FROM (SELECT em.round, v, n, n * {odds("prior", "good", "bad")} AS g
        FROM em, patterns WHERE em.round < {quality.ROUNDS}) GROUP BY round),
model AS (SELECT prior, good, bad FROM em WHERE round = {quality.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {odds("prior", "good", "bad")} >= 0.5 AS kept
FROM b, model
"""


@query("op1_quality_rules", _op1_sql())
def op1_quality_rules(spark, sf_dir):
    table, _ = quality.judged(_read(spark, sf_dir), keep=["doc_id"])
    return table.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    found = simhash.groups(_read(spark, sf_dir))
    return found.select("doc_id", simhash.hexed().alias("fingerprint"), "component_id")


@query("op10_bpe")
def op10_bpe(spark, sf_dir):
    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(_read(spark, sf_dir), ranks, public_tokenizers.PATTERN)


_OP4_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
s AS (
    SELECT doc_id, unnest(range(octet_length(b) - 199)) AS i, b FROM d WHERE octet_length(b) >= 200),
h AS (SELECT doc_id, i, md5(b[i + 1 : i + 200]) AS h FROM s),
-- Starts of strings that begin elsewhere too, and the runs that they cover.
r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (SELECT doc_id, i,
            CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM r)),
c AS (SELECT doc_id, run, min(i) AS lo, max(i) + 200 AS hi FROM g GROUP BY ALL),
-- What stays: before the first run, between runs, after the last.
k AS (
    SELECT doc_id, lo, coalesce(lag(hi) OVER w, 0) AS before, hi, lead(lo) OVER w IS NULL AS last
    FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY lo)),
p AS (
    SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans,
        string_agg(hex(b[before + 1 : lo]) || CASE WHEN last THEN hex(b[hi + 1 :]) ELSE '' END, '' ORDER BY lo) AS kept
    FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
"""


@query("op4_suffix_dedup", _OP4_SQL)
def op4_suffix_dedup(spark, sf_dir):
    docs = _read(spark, sf_dir).select("doc_id", "text")
    found = suffixes.without_repeats(docs)
    return found.select(
        "doc_id",
        (F.octet_length("kept") + F.col("removed_bytes")).cast("long").alias("n_bytes"),
        F.col("removed_bytes").alias("n_removed"),
        F.col("removed_spans").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# CRC-32 of a number's decimal digits, bit by bit.
_CRC = """xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

_OP11_SQL = rf"""
WITH t AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC.format("doc_id")} AS h
    FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
b AS (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i:
            w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
        ELSE w END AS w FROM a),
-- A run has six words in a row that stand again one period later.
x AS (SELECT doc_id, i, w[i + 1 : i + 6] AS six FROM (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM b)),
m AS (
    SELECT x.doc_id, x.i AS k, y.i - x.i AS q FROM x JOIN x AS y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i),
s AS (
    SELECT doc_id, q, min(k) AS start, max(k) + 6 - min(k) + q AS length
    FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, q ORDER BY k) AS stretch FROM m)
    GROUP BY doc_id, q, stretch),
r AS (
    SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(12, 2 * q) GROUP BY ALL),
d AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
o AS (
    SELECT doc_id, count(*) AS n_runs, max_by((start, length, period), (length, -start, -period)) AS best,
        string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS lines
    FROM r GROUP BY doc_id),
k AS (
    SELECT doc_id, string_agg(w[i + 1], ' ' ORDER BY i) AS kept
    FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM b) ANTI JOIN d USING (doc_id, i) GROUP BY doc_id)
SELECT b.doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
    (1000 * best[2]) // best[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(kept, '')) AS collapsed_sha256
FROM b LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op11_periodic_runs", _OP11_SQL)
def op11_periodic_runs(spark, sf_dir):
    docs = _read(spark, sf_dir).select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumns({"h": h, "n": word_count(F.col("text")), "g": F.floor(h / 10)})
    # The case of the tenth of the documents that are made periodic.
    a, n, g = F.col("g") % F.col("n"), F.col("n"), F.col("g")
    p = 1 + F.floor((n - a) / (3 + g % 8))
    w = F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+")
    head, period = F.slice(w, 1, a.cast("int")), F.slice(w, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(period, times)), 1, (n - a).cast("int"))
    made = F.array_join(F.concat(head, rest), " ")
    chosen = (F.col("h") % 10 == 0) & (n > 0)
    docs = docs.select("doc_id", F.when(chosen, made).otherwise(F.col("text")).alias("text"))
    found = runs.periodic_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period))
    best = F.array_max(order)  # struct(length, col2, col3) under their own names below
    found = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.cast("struct<length: long, start: long, period: long>").alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


_OP12_SQL = f"""
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
    FROM conversations),
l AS (SELECT c, list((role, text) ORDER BY pos) AS turns FROM t GROUP BY c),
h AS (SELECT *, c - c % 5 AS base, {_CRC.format("c")} % 9 AS h FROM l),
r AS (
    SELECT h.c, list_concat(coalesce(b.turns[1 : h.h], []), coalesce(h.turns[h.h + 1 :], [])) AS turns
    FROM h LEFT JOIN l AS b ON b.c = h.base),
p AS (SELECT c, d, turns[1 : d] AS node, len(turns) = d AS ends FROM r, unnest(range(len(turns) + 1)) AS x(d)),
n AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf,
        (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(any_value(node)[d][2]) END AS saved,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ended
    FROM p GROUP BY node, d),
up AS (SELECT node[1 : x.d] AS node, leaf, saved FROM n, unnest(range(n.d + 1)) AS x(d)),
below AS (SELECT node, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY node),
kids AS (SELECT node[1 : d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ended) AS ends_sha256
FROM n JOIN below ON below.node = n.node
LEFT JOIN kids ON kids.node = n.node
LEFT JOIN n AS parent ON n.d > 0 AND parent.node = n.node[1 : n.d - 1]
"""


@query("op12_prefix_trie", _OP12_SQL)
def op12_prefix_trie(spark, sf_dir):
    return turns.prefix_trie(_read(spark, sf_dir, "conversations"))


@query("op13_packing")
def op13_packing(spark, sf_dir):
    packed = packing.pack(_read(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(settled(spark), sf_dir)
