"""Registered queries of the corpus operators: name -> (function, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.llm import (
    chat,
    decontaminate,
    lloyd,
    minhash,
    mixing,
    quality,
    simhash,
    substring_dedup,
    token_ids,
    toxicity,
    warc_store,
    whitening,
    winnowing,
)
from cratework.llm.common import Scratch, prepare, table
from cratework.session import fresh_folder

QUERIES: dict[str, tuple] = {}


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return function(prepare(spark), sf)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = (run, sql)
        return function

    return register


TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Every text as frequency-ranked ids in files, read back."""
    folder = fresh_folder(spark, "token-files")
    token_ids.write_ids(table(spark, sf, "documents", "doc_id", "text"), folder, tokenizer_path(), END_ID)
    return token_ids.id_digests(token_ids.read_ids(spark, folder))


REPEATS_SQL = r"""
WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 18)) AS i,
        unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS s FROM split WHERE len(w) >= 20
), numbered AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS turn FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM numbered WHERE turn > 1
), words AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM split
), left_over AS (
    SELECT doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone.i IS NULL) AS kept
    FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN left_over USING (doc_id)
"""


@query(REPEATS_SQL)
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each document without words that an earlier window of 20 words repeats."""
    cut = substring_dedup.remove_repeats(table(spark, sf, "documents", "doc_id", "text"), window=20, start=10)
    return substring_dedup.digest_columns(cut)


@query()
def op3_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every text and its edited text, from a hash at every character."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    return winnowing.compare_edited(docs, winnowing.add_rolling_fingerprint)


@query()
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items found in documents."""
    docs, items = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    return decontaminate.find_leaks(docs, items)


CHAT_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
    SELECT *, 2 * length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
        + 2 * length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', ''))
        + length('### : </turn>') + 1 AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


@query(CHAT_SQL)
def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations from their event log, rendered and read back."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    marks = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string"
    )
    log = chat.log_of(rows).union(chat.log_of(extra))
    return chat.read_back(chat.format_chats(log))


def _remainder(doc_id, divisor: int):
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % divisor


QUALITY_LEAST = 0.7


@query()
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """A quality score for every document, learned from labels that are not held out."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels", "doc_id", "quality")
    space = quality.fit(docs, labels, "quality", learn=lambda doc_id: _remainder(doc_id, 4) != 2)
    return quality.score(docs, space).select(
        "doc_id",
        (_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"),
    )


@query()
def op7_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of three-word shingles and the groups that two bits link."""
    groups = simhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"), shingle=3, radius=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """A toxicity score for every document, of its deobfuscated text."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels, "toxic", learn=lambda doc_id: _remainder(doc_id, 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


WARC_SQL = """
WITH bodies AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS owner FROM bodies
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN owner END AS refers_to
FROM firsts
"""


@query(WARC_SQL)
def op9_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in a content-addressed archive, their records written to WARC files and read from these."""
    folder = fresh_folder(spark, "warc")
    warc_store.write_archive(table(spark, sf, "pages", "page_id", "url", "html"), folder)
    exported = warc_store.export_files(warc_store.read_archive(spark, folder), f"{folder}/files")
    return warc_store.describe_records(scratch_records(spark, exported))


def scratch_records(spark: SparkSession, exported: DataFrame) -> DataFrame:
    """The parsed records, written once for the two reads of the join."""
    return Scratch(spark, "warc-records").stage(warc_store.read_records(exported), "records")


@query()
def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of each document the weighted mix of its source takes."""
    mixed = mixing.mix(table(spark, sf, "documents", "doc_id", "source", "text"), weights=(1, 2, 3), most=3)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


@query()
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """The first four whitened components of every vector; ``deviation`` must fit a long here."""
    whole = whitening.whole_vectors(table(spark, sf, "embeddings", "vec_id", "embedding"), scale=256)
    white = whitening.whiten(whole, whitening.fit(whole, components=4))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


NEAR_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM split
), sets AS (
    SELECT doc_id, len(s) AS n, sha256(array_to_string(list_sort(s), chr(10))) AS digest, s FROM shingles
), nodes AS (
    SELECT digest, min(doc_id) AS node, any_value(n) AS n, any_value(s) AS s FROM sets WHERE n > 0 GROUP BY digest
), spread AS (
    SELECT node, n, unnest(s) AS shingle FROM nodes
), links AS (
    SELECT a.node AS u, b.node AS v FROM spread a JOIN spread b ON a.shingle = b.shingle AND a.node <> b.node
    WHERE 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT node, node AS other FROM nodes
    UNION SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.other
), roots AS (
    SELECT nodes.digest, min(reach.other) AS component_id FROM reach JOIN nodes ON nodes.node = reach.node GROUP BY nodes.digest
)
SELECT doc_id, n::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN roots ON sets.n > 0 AND sets.digest = roots.digest
"""


@query(NEAR_SQL)
def op12_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles are 85 % alike."""
    return minhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"), shingle=5, percent=85)


def _lloyd_sql(count: int, rounds: int, size: int, scale: int, prefix: str) -> str:
    """Every round as a step of its own; floored division written for whole numbers of either sign."""
    steps = [
        f"""kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(c::DOUBLE * {scale})::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND abs(c) < 'inf'::FLOAT)) = {size}
), entries AS MATERIALIZED (
    SELECT r, unnest(range(1, {size + 1})) AS i, unnest(x) AS x FROM kept
), firsts AS (
    SELECT row_number() OVER (ORDER BY sha256('{prefix}' || vec_id), x) - 1 AS c, x
    FROM kept QUALIFY c < {count}
), centre_0 AS MATERIALIZED (SELECT c, unnest(range(1, {size + 1})) AS i, unnest(x) AS x FROM firsts)"""
    ]
    for turn in range(rounds + 1):
        steps.append(
            f"""label_{turn} AS MATERIALIZED (
    SELECT r, (min({{'d': d, 'c': c}})).c AS c, min(d) AS d FROM (
        SELECT e.r, m.c, sum((e.x - m.x) * (e.x - m.x))::BIGINT AS d FROM entries e JOIN centre_{turn} m ON e.i = m.i GROUP BY e.r, m.c
    ) GROUP BY r
)"""
        )
        if turn < rounds:
            steps.append(
                f"""centre_{turn + 1} AS MATERIALIZED (
    SELECT m.c, m.i, coalesce(((s.t - ((s.t % s.n) + s.n) % s.n) // s.n)::BIGINT, m.x) AS x
    FROM centre_{turn} m LEFT JOIN (
        SELECT l.c, e.i, sum(e.x)::BIGINT AS t, count(*) AS n FROM entries e JOIN label_{turn} l ON e.r = l.r GROUP BY l.c, e.i
    ) s ON m.c = s.c AND m.i = s.i
)"""
            )
    return f"""WITH {", ".join(steps)}, digests AS (
    SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centre_{rounds} GROUP BY c
)
SELECT vec_id, l.c::INTEGER AS cluster, l.d AS distance, (sum(l.d) OVER (PARTITION BY l.c))::BIGINT AS cluster_inertia,
    (sum(l.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM label_{rounds} l JOIN kept ON kept.r = l.r JOIN digests ON digests.c = l.c
"""


@query(_lloyd_sql(count=8, rounds=10, size=64, scale=1024, prefix="3:"))
def op13_sharded_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    """Ten rounds of clustering in whole numbers, by shards of the columns."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    return lloyd.describe(*lloyd.cluster(vectors, size=64, count=8, rounds=10, scale=1024, prefix="3:"))
