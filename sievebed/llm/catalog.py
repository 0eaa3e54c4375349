"""The queries of this subpackage over the given tables, and their SQL where SQL can say them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sievebed.catalog.base import Query, table
from sievebed.llm import chat, decontaminate, langid, lines, neighbours, passages, pieces, quality, repair, sharding, simhash, tokens, whitening


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings; digests of what is read back."""
    said = "</s>[INST] ok [/INST]"
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said)
    )
    read = chat.formatted_text(chat.format_chats(given.union(added)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, loss, formatted = (batch[name].to_pylist() for name in ("turns", "loss_text", "formatted"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"], pa.array([len(x) for x in turns], pa.int64()),
                    pa.array([_hex("".join(f"{t['role']}\n{t['text']}\n" for t in x)) for x in turns]),
                    pa.array([len(x) for x in loss], pa.int64()), pa.array([_hex(x) for x in loss]),
                    pa.array([len(x) for x in formatted], pa.int64()),
                ],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return read.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


# An escaped text is longer by one sign for each escape sign, and a control string becomes two signs.
CHAT_SQL = r"""
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text))
            AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::bigint AS loss_chars,
        sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
            AS loss_sha256,
        (3 + sum(6 + 7 + 4 + length(escaped)))::bigint AS formatted_chars
    FROM (
        SELECT conv_id, turn, role, text, replace(replace(replace(replace(replace(
            coalesce(role, '') || coalesce(text, ''), '\', '\\'), '<s>', '\a'), '[INST]', '\b'), '[/INST]', '\c'),
            '</s>', '\d') AS escaped
        FROM (SELECT conv_id, turn, role, text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
              UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    )
    GROUP BY conv_id
"""


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"), words=3, distance=2)
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fingerprint_bits")).alias("fingerprint"), "component_id"
    )


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines of every document stay: one of each class of near lines."""
    return lines.decisions(table(spark, folder, "documents")).select("doc_id", "n_lines", "dropped")


def op4_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    )
    placed = sharding.byte_shards(documents, 8, keep_text=False)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.token_counts(documents, limit=512, vocabulary="byte_bpe_50k.json")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = langid.train(documents)
    found = langid.predictions(documents.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether the text that comes back from them is the same."""
    documents = table(spark, folder, "documents").select(
        "doc_id", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "text"
    )
    back = pieces.decoded(pieces.encoded(documents), keep_ids=True)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
        F.crc32(F.col("text").cast("binary")).eqNullSafe(F.col("text_crc32")).alias("round_trip"),
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


DECONTAMINATION_SQL = r"""
    WITH item_words AS (
        SELECT item_id::varchar AS item_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
        FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS words
        FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
              FROM item_words WHERE len(w) > 0)
    ), doc_words AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
        FROM documents
    ), places AS (
        SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS words
        FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s
              FROM doc_words, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
    ), hits AS (SELECT r, p.m, s, item_id FROM places p JOIN windows USING (m, words)),
    covered AS (
        SELECT r, count(DISTINCT word) AS n_hit
        FROM (SELECT r, unnest(range(s, s + m)) AS word FROM (SELECT DISTINCT r, s, m FROM hits)) GROUP BY r
    ), named AS (
        SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
    )
    SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
        coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    return neighbours.nearest(embeddings, F.col("vec_id") % 20 == 0, 20)


NEIGHBOURS_SQL = """
    WITH usable AS (
        SELECT vec_id, embedding::double[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
        FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, rank::int AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    WHERE rank <= 20
"""



def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, folder, "labels"))
    found = quality.scores(documents, model)
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(embeddings)
    n, error = (model.n, model.identity_error) if model else (0, 0.0)
    rows = whitening.by_component(whitening.whitened(embeddings, model), model)
    return rows.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, as a checksum of conversation and turn says."""
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(name, F.lit(" ")) for name in ("text", "role"))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _line_hashes(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines.  One hash takes its input in order: a conversation streams through a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None

        def done(ids: list[tuple], digests: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, in ids], pa.int64()), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"]
            )

        for batch in batches:
            ids, digests = [], []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (conv,) != held:
                    if held is not None:
                        ids.append(held)
                        digests.append(digest.hexdigest())
                    held, digest = (conv,), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            yield done(ids, digests)
        if held is not None:
            yield done([held], [digest.hexdigest()])

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "place")
    return ordered.select("conv_id", "line").mapInArrow(run, "conv_id long, repaired_sha256 string")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows, report = repair.repair(damaged(given))
    hashes = _line_hashes(rows.select("conv_id", "piece", "place", F.concat_ws(":", "role", "text").alias("line")))
    found = given.select("conv_id").distinct()
    for number, part in enumerate((report, hashes)):
        named = part.withColumnRenamed("conv_id", f"conv_{number}")
        found = found.join(named, F.col("conv_id").eqNullSafe(F.col(f"conv_{number}")), "left").drop(f"conv_{number}")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_hex(""))).alias("repaired_sha256"),
    )


# The walk holds, per state behind each row, the cheapest edits, the first by letter of equally cheap ones.
REPAIR_SQL = r"""
    WITH RECURSIVE crc_table AS (
        SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, bit:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
    ), kinds AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                lambda x: ord(x)::bigint), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS kind
        FROM conversations, crc_table
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place
        FROM damaged
    ), judged AS (
        SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
            NOT regexp_matches(text, '[^ 	-
]') AS blank,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS seen,
            NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut
        FROM placed
    ), faults AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::bigint AS gaps,
            count(*) FILTER (blank)::bigint AS blank, count(*) FILTER (NOT blank AND seen)::bigint AS duplicate,
            count(*) FILTER (NOT blank AND NOT seen AND cut)::bigint AS truncated,
            count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::bigint AS illegal,
            max(place) AS rows
        FROM judged GROUP BY conv_id
    ), inserts AS (
        SELECT * FROM (VALUES (0, 0, '', ''), (0, 2, 'I', '|user:'), (0, 3, 'II', '|user:|assistant:'), (1, 1, '', ''),
            (1, 2, 'I', '|user:'), (1, 3, 'II', '|user:|assistant:'), (2, 2, '', ''), (2, 3, 'I', '|assistant:'),
            (3, 3, '', ''), (3, 2, 'I', '|user:'), (3, 3, 'II', '|user:|assistant:')) x(s, m, letters, lines)
    ), acts AS (
        SELECT * FROM (VALUES (0, 'K', 's', NULL, 1), (0, 'K', 'u', NULL, 2), (1, 'K', 'u', NULL, 2), (2, 'K', 'a', NULL, 3),
            (3, 'K', 'u', NULL, 2), (0, 'R', NULL, 'user', 2), (1, 'R', NULL, 'user', 2), (2, 'R', NULL, 'assistant', 3),
            (3, 'R', NULL, 'user', 2), (0, 'D', NULL, NULL, 0), (1, 'D', NULL, NULL, 1), (2, 'D', NULL, NULL, 2),
            (3, 'D', NULL, NULL, 3)) x(m, letter, initial, role, t)
    ), walk AS (
        SELECT conv_id, 0::bigint AS place, 0 AS s, {'cost': 0::bigint, 'audit': '', 'lines': ''} AS best FROM faults
        UNION ALL
        SELECT w.conv_id, w.place + 1, t, min({
            'cost': best.cost + 2 * length(letters) + CASE letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                + CASE WHEN letter <> 'D' AND cut THEN 1 ELSE 0 END,
            'audit': best.audit || letters || letter,
            'lines': best.lines || replace(lines, '|', chr(10))
                || CASE WHEN letter = 'D' THEN '' ELSE chr(10) || coalesce(a.role, j.role) || ':' || text END})
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
            JOIN inserts i ON i.s = w.s JOIN acts a ON a.m = i.m
        WHERE (letter = 'D' OR NOT (blank OR seen)) AND (letter <> 'K' OR a.initial = j.initial)
        GROUP BY w.conv_id, w.place, t
    ), repaired AS (
        SELECT f.conv_id, min({'cost': best.cost + 2 * length(letters), 'audit': best.audit || letters,
            'lines': best.lines || replace(lines, '|', chr(10))}) AS best
        FROM faults f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.place = f.rows JOIN inserts i ON i.s = w.s
        WHERE i.m = 3 OR w.s = 0 AND i.m = 0
        GROUP BY f.conv_id
    )
    SELECT c.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank,
        coalesce(duplicate, 0)::bigint AS duplicate, coalesce(truncated, 0)::bigint AS truncated,
        coalesce(illegal, 0)::bigint AS illegal, coalesce(best.cost, 0)::bigint AS cost, coalesce(best.audit, '') AS audit,
        sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


QUERIES = {
    "op1_chat_format": Query(op1_chat_format, CHAT_SQL),
    "op2_simhash": Query(op2_simhash),
    "op3_line_dedup": Query(op3_line_dedup),
    "op4_passages": Query(op4_passages),
    "op5_sharding": Query(op5_sharding),
    "op6_token_counts": Query(op6_token_counts),
    "op7_language": Query(op7_language),
    "op8_pieces": Query(op8_pieces),
    "op9_decontamination": Query(op9_decontamination, DECONTAMINATION_SQL),
    "op10_neighbours": Query(op10_neighbours, NEIGHBOURS_SQL),
    "op11_quality": Query(op11_quality),
    "op12_whitening": Query(op12_whitening),
    "op13_repair": Query(op13_repair, REPAIR_SQL),
}
