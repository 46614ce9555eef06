"""Registered queries of the operators and their SQL, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import ann, langid, lexical, licenses, mixing, packing, pii, quality, repeats, resampling, simhash, url_filter, warc
from adtally.llm.shared import WORD, bound_to, table, written

URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]

#: Shares of tokens are raised to these powers: below 1, rare values gain.
MIX_POWERS = {"source": 0.8, "language": 0.8, "topic": 0.8}


def op1_segmented_hosts(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge(table(spark, d, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def topic_of(text: Column) -> Column:
    """A stand-in for a topic column, which the table lacks: the first of these kinds that fits."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.rlike("(?i)licen[cs]e|copyright"), "notice")
        .when(text.contains("@") | text.contains("+1 ("), "contact")
        .when(text.rlike("[#*$%&|<>]"), "markup")
        .when(F.length(text) < 1000, "short")
        .when(F.length(text) < 6000, "medium")
        .otherwise("long")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """Documents with the mix's columns added (see mixing.mix)."""
    margins = {"source": F.col("source"), "language": F.col("lang"), "topic": topic_of(F.col("text"))}
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return mixing.mix(docs.select("doc_id", "text", "lang", "source", "n_chars"), margins, MIX_POWERS, tokens)


def op2_raked_mix(spark: SparkSession, d: str) -> DataFrame:
    mixed = mix_documents(table(spark, d, "documents"))
    return mixed.select(
        "doc_id", F.col("mix_source").alias("source"), F.col("mix_language").alias("lang"), F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"), "probability", "kept",
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """Pieces of at most 2048 tokens with a digest of their ids in place of the ids."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_cost_balanced_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"))


def op4_dictionary_warc(spark: SparkSession, d: str) -> DataFrame:
    archives = written(warc.write(table(spark, d, "pages"), warc.new_folder(spark)), "archives")
    return warc.read(spark, archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def learned_rules(spark: SparkSession, d: str, docs: DataFrame) -> quality.DecisionList:
    return quality.learn(docs, table(spark, d, "labels"))


def op5_decision_list(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return quality.judge(docs, learned_rules(spark, d, docs))


def op6_checked_personal_data(spark: SparkSession, d: str) -> DataFrame:
    found = pii.find(table(spark, d, "documents"))
    base = [k.name for k in pii.KINDS if k.base]

    def counted(spans: Column) -> Column:
        of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
        return F.struct(
            *[of(k) for k in base],
            F.sha2(text(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
            text(spans).alias("spans"),
        )

    return found.select("doc_id", bound_to(F.col("spans"), counted).alias("c")).select("doc_id", "c.*")


def op7_golay_simhash(spark: SparkSession, d: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, d, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_learned_partitions(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of an id leaves no rest by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op9_bitmask_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    filters = langid.learn(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text"))
    found = langid.identify(docs, filters)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_merged_suffix_runs(spark: SparkSession, d: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, d, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_gram_resampling(spark: SparkSession, d: str) -> DataFrame:
    drawn = resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_pipelined_terms(spark: SparkSession, d: str) -> DataFrame:
    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


def op13_rare_word_licences(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    at = F.transform("places", lambda p: p["at"].cast("long"))
    base = F.array_join(F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))), ",")
    return licenses.scan(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"), base.alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_segmented_hosts": op1_segmented_hosts,
    "op2_raked_mix": op2_raked_mix,
    "op3_cost_balanced_packing": op3_cost_balanced_packing,
    "op4_dictionary_warc": op4_dictionary_warc,
    "op5_decision_list": op5_decision_list,
    "op6_checked_personal_data": op6_checked_personal_data,
    "op7_golay_simhash": op7_golay_simhash,
    "op8_learned_partitions": op8_learned_partitions,
    "op9_bitmask_language": op9_bitmask_language,
    "op10_merged_suffix_runs": op10_merged_suffix_runs,
    "op11_gram_resampling": op11_gram_resampling,
    "op12_pipelined_terms": op12_pipelined_terms,
    "op13_rare_word_licences": op13_rare_word_licences,
}

# --- SQL ---------------------------------------------------------------------------------


def _mix_sql(rounds: int = 60, second: int = 60) -> str:
    """The rakes of the three margins, then those below the cut, written out; they settle long before the last."""
    margins = ("source", "lang", "topic")
    steps, last = [], "c0"

    def step(name: str, factor: str) -> None:
        nonlocal last
        steps.append(f"{name} AS MATERIALIZED (SELECT * REPLACE ({factor} AS f) FROM {last})")
        last = name

    for k in range(rounds):
        for m in margins:
            now = f"sum(tokens * f) OVER (PARTITION BY {m})"
            step(f"c{k}_{m}", f"CASE WHEN {now} > 0 THEN f * goal_{m} / {now} ELSE f END")
    goals = ", ".join(
        f"t_{m} AS (SELECT {m}, sum(tokens) AS own_{m}, pow(sum(tokens), 0.8) / sum(pow(sum(tokens), 0.8)) OVER () AS share_{m},"
        f" pow(sum(tokens), 0.8) / sum(pow(sum(tokens), 0.8)) OVER () * (SELECT sum(tokens) FROM cells) AS goal_{m}"
        f" FROM cells GROUP BY {m})"
        for m in margins
    )
    fitted = last
    # values from the scarcest on: those are kept whole whose share of what is left exceeds them
    aims = ", ".join(
        f"""w_{m} AS (SELECT {m}, own_{m}, share_{m}, own_{m} / share_{m} AS reach,
                       ((SELECT mass FROM s2) - coalesce(sum(own_{m}) OVER (ORDER BY own_{m} / share_{m}, {m} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                         / sum(share_{m}) OVER (ORDER BY own_{m} / share_{m}, {m} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale
                FROM t_{m}),
            a_{m} AS (SELECT {m}, least(own_{m}, share_{m} * coalesce((SELECT arg_min(scale, reach) FROM w_{m} WHERE reach > scale), 1e300)) AS aim_{m} FROM t_{m})"""
        for m in margins
    )
    first = list(steps)
    steps, last = [], "e0"
    for k in range(second):
        for m in margins:
            over = f"OVER (PARTITION BY {m})"
            below, held = f"sum(CASE WHEN f < 1 THEN f * tokens ELSE 0 END) {over}", f"sum(CASE WHEN f >= 1 THEN tokens ELSE 0 END) {over}"
            every = f"sum(f * tokens) {over}"
            step(
                f"e{k}_{m}",
                f"f * CASE WHEN {below} > 0 AND aim_{m} > {held} THEN (aim_{m} - {held}) / {below}"
                f" WHEN (aim_{m} < {held} OR {below} > 0) AND {every} > 0 THEN aim_{m} / {every} ELSE 1 END",
            )
    return f"""
        WITH d AS (
          SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
                 CASE WHEN regexp_matches(text, '(?i)licen[cs]e|copyright') THEN 'notice'
                      WHEN contains(text, '@') OR contains(text, '+1 (') THEN 'contact'
                      WHEN regexp_matches(text, '[#*$%&|<>]') THEN 'markup'
                      WHEN length(coalesce(text, '')) < 1000 THEN 'short'
                      WHEN length(text) < 6000 THEN 'medium' ELSE 'long' END AS topic,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
          FROM documents),
        cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
        {goals},
        c0 AS (SELECT source, lang, topic, tokens, goal_source, goal_lang, goal_topic, CAST(1 AS DOUBLE) AS f
               FROM cells JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)),
        {", ".join(first)},
        s AS (SELECT f, sum(tokens) OVER (ORDER BY f) AS up_to, sum(tokens) OVER () AS total FROM {fitted}),
        g AS MATERIALIZED (
          SELECT source, lang, topic, tokens, f / (SELECT min(f) FROM s WHERE up_to > floor((total - 1) * 0.95)) AS f FROM {fitted}),
        s2 AS MATERIALIZED (SELECT sum(least(f, 1) * tokens) AS mass FROM g),
        {aims},
        e0 AS MATERIALIZED (
          SELECT source, lang, topic, tokens, f, aim_source, aim_lang, aim_topic
          FROM g JOIN a_source USING (source) JOIN a_lang USING (lang) JOIN a_topic USING (topic)),
        {", ".join(steps)},
        p AS (SELECT source, lang, topic, round(least(f, 1.0), 6) AS probability FROM {last})
        SELECT doc_id, source, lang, topic, d.tokens AS tokens, probability,
               CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
                 / 4503599627370496.0 < probability AS kept
        FROM d JOIN p USING (source, lang, topic)"""


_WARC_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
    k AS (SELECT digest, max(page_id) AS kept FROM p GROUP BY digest)
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr(
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((CAST('0x' || substr(digest, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM kept AND kept IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
    FROM p JOIN k USING (digest)"""

# The checksum of each different word is a fold over its bytes with the table of the polynomial
# 0xEDB88320; words come from the texts by the contract's pattern.
_RESAMPLING_SQL = r"""
    WITH RECURSIVE shift(i, c, k) AS (
      SELECT i, CAST(i AS BIGINT), 0 FROM range(256) AS r(i)
      UNION ALL
      SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM shift WHERE k < 8),
    crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM shift WHERE k = 8),
    upper AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
    d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM documents, upper),
    dw AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY ALL),
    bw AS MATERIALIZED (
      SELECT word, count(*) AS n
      FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark, upper) GROUP BY ALL),
    bytes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
    buckets AS MATERIALIZED (
      SELECT word, xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(h) // 2 AS BIGINT)),
                            lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
               lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
      FROM bytes, crc),
    s AS (SELECT bucket, sum(n) AS s FROM dw JOIN buckets USING (word) GROUP BY bucket),
    t AS (SELECT bucket, sum(n) AS t FROM bw JOIN buckets USING (word) GROUP BY bucket),
    sums AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM s) AS DOUBLE) AS all_s, CAST((SELECT coalesce(sum(t), 0) FROM t) AS DOUBLE) AS all_t),
    gains AS MATERIALIZED (
      SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), sums),
    weights AS (
      SELECT r, sum(n) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
      FROM dw JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
    scored AS (
      SELECT r, doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)
               + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN weights USING (r)),
    ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS rank, count(*) OVER () AS n
               FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
    FROM scored LEFT JOIN ranked USING (r)"""

_SEARCH_SQL = r"""
    WITH upper AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
    d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents, upper),
    i AS MATERIALIZED (
      SELECT row_number() OVER () AS j, item_id,
             list_distinct(regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
      FROM benchmark, upper),
    it AS (SELECT j, unnest(terms) AS term FROM i),
    s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_words FROM d WHERE len(terms) > 0),
    p AS MATERIALIZED (
      SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM it) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
          FROM p, s GROUP BY term, n_docs),
    c AS MATERIALIZED (
      SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(terms) * n_docs) // n_words))) AS c
      FROM p JOIN w USING (term) JOIN d USING (r), s),
    scores AS (SELECT j, r, CAST(sum(c) AS BIGINT) AS score FROM it JOIN c USING (term) GROUP BY j, r),
    ranked AS (SELECT j, doc_id, score, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id, r) AS rank
               FROM scores JOIN d USING (r) WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (j) WHERE rank <= 10"""

def _licence_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(
        f"({k}, {quoted(t.label)}, {quoted(' '.join(licenses.words_of(t.text)))}, "
        f"[{', '.join(quoted(' ' + ' '.join(licenses.words_of(p)) + ' ') for p in t.phrases)}])"
        for k, t in enumerate(licenses.TEMPLATES)
    )
    phrases = ", ".join(f"({quoted(label)}, {quoted(p)}, {len(p.split())})" for p, label in licenses.PHRASES)
    slack = licenses.SLACK
    return f"""
        WITH t AS MATERIALIZED (SELECT k, label, string_split(words, ' ') AS words, phrases FROM (VALUES {rows}) AS v(k, label, words, phrases)),
        d AS MATERIALIZED (
          SELECT row_number() OVER () AS r, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
          FROM documents),
        places AS (
          SELECT r, label, pos FROM (SELECT r, words, unnest(range(len(words))) AS pos FROM d) CROSS JOIN (VALUES {phrases}) AS p(label, phrase, n)
          WHERE array_to_string(list_slice(words, pos + 1, pos + n), ' ') = phrase),
        tw AS (SELECT k, word, pos FROM (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS pos FROM t)),
        dw AS MATERIALIZED (
          SELECT r, word, pos FROM (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d) WHERE word IN (SELECT word FROM tw)),
        n AS (SELECT word, count(DISTINCT r) AS n FROM (SELECT word, NULL AS r FROM tw UNION ALL SELECT word, r FROM dw) GROUP BY word),
        file_rare AS (
          SELECT r, word FROM (SELECT DISTINCT r, word, n FROM dw JOIN n USING (word))
          QUALIFY row_number() OVER (PARTITION BY r ORDER BY n, word) <= {licenses.FILE_WORDS}),
        own_rare AS (
          SELECT k, word FROM (SELECT DISTINCT k, word, n FROM tw JOIN n USING (word))
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY n, word) <= {licenses.TEMPLATE_WORDS}),
        needs AS (SELECT k, least({licenses.AGREE}, count(*)) AS need FROM own_rare GROUP BY k),
        begins AS (
          SELECT r, k, dw.pos - tw.pos AS b
          FROM own_rare JOIN file_rare USING (word) JOIN tw USING (k, word) JOIN dw USING (r, word) JOIN needs USING (k)
          GROUP BY r, k, b, need HAVING count(DISTINCT word) >= need),
        parts AS (
          SELECT r, k, label, t.words AS words, phrases,
                 list_slice(d.words, greatest(b - {slack}, 0) + 1, greatest(b + len(t.words) + {slack}, 0)) AS part
          FROM begins JOIN d USING (r) JOIN t USING (k)),
        notices AS (
          SELECT r, label, len(list_intersect(words, part)) / len(list_distinct(words)) AS share FROM parts
          WHERE len(list_filter(phrases, lambda p: contains(' ' || array_to_string(part, ' ') || ' ', p))) = len(phrases)),
        base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
                        array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels FROM places GROUP BY r),
        every AS (SELECT r, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
                  FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM notices) GROUP BY r),
        best AS (SELECT r, max(share) AS share FROM notices GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
        FROM d LEFT JOIN base USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)"""


#: The other queries learn a model, call a tokenizer or hash as DuckDB can't; see tests/llm.
ORACLES: dict[str, str] = {"op2_raked_mix": _mix_sql(), "op4_dictionary_warc": _WARC_SQL, "op11_gram_resampling": _RESAMPLING_SQL, "op12_pipelined_terms": _SEARCH_SQL, "op13_rare_word_licences": _licence_sql()}
