"""One query for each operator over its whole given table, and SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import balltree, boosting, bpe, chat, contamination, crossentropy, files, kernel, rans, repair, separators, setjoin, simhash, stats, suffixes
from siltstone.sources.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    files.ship(spark)
    return spark.read.parquet(f"{path}/{name}.parquet")


@query("op1_chat_tree", """
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    f AS (SELECT *, replace(replace(replace(text, '\\', '\\\\'), '###', '\\###'), '</turn>', '\\</turn>') AS shown FROM c)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(length('### ' || role || ': ' || shown || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
    FROM f GROUP BY conv_id""")
def op1(spark: SparkSession, path: str) -> DataFrame:
    """All conversations, packed as a prefix tree and read back from it."""
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = table(spark, path, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    branches, conversations = chat.packed(rows, tokenizer)
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    learned = F.concat_ws("", "learned")
    found = stage(chat.turns(chat.unpacked(branches, tokenizer)).select(
        "leaf", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars")), "read-back")
    return conversations.join(found, "leaf").drop("leaf")


@query("op2_separator_scan")
def op2(spark: SparkSession, path: str) -> DataFrame:
    """Token counts of all documents, found in flat token files."""
    separator, folder = 50256, files.shared_folder(spark, "flat")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    written = stage(separators.write_flat(table(spark, path, "documents"), folder, tokenizer, separator), "flat-docs")
    names = written.select("file").distinct()
    sizes = spark.createDataFrame(files.file_sizes(folder), "file string, n_bytes long").join(names, "file", "left_semi")
    found = separators.scan_flat(sizes, separator, separators.width_of(tokenizer, separator))
    # Both sides have a row for each document, and file names shrink so well that they look fit for a broadcast.
    return written.hint("merge").join(found, ["file", "place"], "left").select("doc_id", "n_tokens", "terminated")


@query("op3_bpe")
def op3(spark: SparkSession, path: str) -> DataFrame:
    """Ids of all documents and the text that they decode to, as digests."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, path, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, tokenizer).drop("text"), tokenizer)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_boosted_rules")
def op4(spark: SparkSession, path: str) -> DataFrame:
    """Counts of all documents, the base rules and the verdict of the trees."""
    measured = stage(stats.measure(table(spark, path, "documents")), "measured")
    forest = boosting.learn(measured, table(spark, path, "labels"))
    return boosting.judge(measured, forest).select("doc_id", *stats.COUNTS, "base_failed", "kept", "score")


@query("op5_kernel_ridge")
def op5(spark: SparkSession, path: str) -> DataFrame:
    """Quality scores of all documents."""
    measured = stage(stats.measure(table(spark, path, "documents")), "measured")
    model = kernel.learn(measured, table(spark, path, "labels"))
    return kernel.score(measured, model).select(
        "doc_id", (kernel.fold_of() == 1).alias("held_out"), "score", "predicted")


@query("op6_setjoin")
def op6(spark: SparkSession, path: str) -> DataFrame:
    """Near duplicates of four-word shingles."""
    return setjoin.linked(table(spark, path, "documents"), setjoin.Rule(shingle=4, percent=80))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, path: str) -> DataFrame:
    """Documents without the 50-byte strings that start in an earlier one."""
    found = suffixes.deduplicated(table(spark, path, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_cross_entropy_difference")
def op8(spark: SparkSession, path: str) -> DataFrame:
    """Losses of all documents under models of the well-rated documents and of all."""
    good = table(spark, path, "labels").filter("quality = 1").select("doc_id")
    return crossentropy.score(table(spark, path, "documents"), good)


@query("op9_rans")
def op9(spark: SparkSession, path: str) -> DataFrame:
    """Ids of all documents, read back from the coded files."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    tokenized = stage(rans.tokenize(table(spark, path, "documents"), tokenizer, 2), "ids")
    coded = rans.table_of(rans.count(tokenized))
    manifest = stage(rans.write(tokenized, coded, files.shared_folder(spark, "rans")), "rans")
    return rans.read(manifest, coded).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op10_decontamination")
def op10(spark: SparkSession, path: str) -> DataFrame:
    """Documents that contain a test item, as it is or edited, and the share of the item that aligns."""
    return contamination.matches(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query("op11_ball_tree", r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    i AS (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    sizes AS (SELECT r, doc_id, count(*) AS n FROM d GROUP BY 1, 2),
    whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
    tf AS (SELECT r, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM tf, whole GROUP BY term, docs),
    scores AS (SELECT q.item_id, r, doc_id, CAST(sum(q.times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
        FROM (SELECT item_id, term, count(*) AS times FROM i GROUP BY 1, 2) q JOIN tf USING (term) JOIN w USING (term)
        JOIN sizes USING (r), whole GROUP BY 1, 2, 3)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10""")
def op11(spark: SparkSession, path: str) -> DataFrame:
    """The ten best documents of each item."""
    return balltree.ranked(table(spark, path, "documents"), table(spark, path, "benchmark"))


# Each way from a state over a row: insertions, then what is done to the row. States: nothing yet, system, user, assistant.
_STEPS, _TURN_OF, _BEHIND = [], "uuau", (2, 2, 3, 2)
for _start in range(4):
    _state = _start
    for _n in range(3):
        _STEPS.append((_start, "*", "I" * _n + "D", 3 * _n + 4, 0, 0, _state))
        _STEPS.append((_start, _TURN_OF[_state], "I" * _n + "K", 3 * _n, 3, 1, _BEHIND[_state]))
        _STEPS.append((_start, "*", "I" * _n + "R", 3 * _n + 3, 3, 1, _BEHIND[_state]))
        if _state == 0:
            _STEPS.append((_start, "s", "K", 0, 3, 1, 1))
        _state = _BEHIND[_state]


@query("op12_conversation_repair", f"""
    WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    dealt AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(k, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 20 AS d FROM keyed),
    damaged AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
        CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE d WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM dealt WHERE d <> 0),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        substr(role, 1, 1) AS initial FROM damaged),
    judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
    sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
    steps(q, initial, letters, cost, cut, stays, q2) AS (VALUES {", ".join(map(str, _STEPS))}),
    ways AS (SELECT conv_id, n + 1 AS i, unnest([0, 1, 2, 3]) AS q, unnest(['000000000', '000000006II', '000000003I', '000000000']) AS best
        FROM sums
      UNION ALL SELECT r.conv_id, r.i, s.q, min(lpad(CAST(s.cost + CASE r.fault WHEN 'truncated' THEN s.cut ELSE 0 END
          + CAST(substr(w.best, 1, 9) AS BIGINT) AS VARCHAR), 9, '0') || s.letters || substr(w.best, 10))
        FROM ways w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1
        JOIN steps s ON s.q2 = w.q AND s.initial IN ('*', r.initial) AND (s.stays = 0 OR r.fault NOT IN ('blank', 'duplicate'))
        GROUP BY r.conv_id, r.i, s.q),
    audits AS (SELECT conv_id, CAST(substr(best, 1, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM ways WHERE i = 1 AND q = 0),
    letters AS (SELECT conv_id, audit, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS p
        FROM audits WHERE audit <> ''),
    placed AS (SELECT *, sum(CASE letter WHEN 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE letter WHEN 'D' THEN 0 ELSE 1 END) OVER w AS place
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
    turned AS (SELECT l.conv_id, l.p, l.letter, l.place, r.role, CASE l.letter WHEN 'I' THEN '' ELSE r.text END AS text,
        max(CASE WHEN l.place = 1 AND l.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS has_system
        FROM placed l LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
    texts AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role
          WHEN (place - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS sha FROM turned GROUP BY conv_id),
    everyone AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT e.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
      coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost,
      coalesce(a.audit, '') AS audit, coalesce(t.sha, sha256('')) AS repaired_sha256
    FROM everyone e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
      LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM e.conv_id""")
def op12(spark: SparkSession, path: str) -> DataFrame:
    """All conversations, damaged by a rule, then repaired at the least cost."""
    rows = table(spark, path, "conversations")
    found, turns = repair.repaired(damaged(rows))
    empty = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "", "sha256": hashlib.sha256().hexdigest()}
    every = rows.select("conv_id").distinct()
    for part in (found.withColumnRenamed("conv_id", "_id"), repair.digests(turns).select(F.col("conv_id").alias("_id"), "sha256")):
        every = every.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return every.fillna(empty, list(empty)).withColumnRenamed("sha256", "repaired_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations of which a twentieth of the rows each is lost, emptied, cut, repeated or given the role of a user."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rule = F.crc32(key) % 20
    return rows.select(
        "conv_id", "turn", F.when(rule == 4, "user").otherwise(role).alias("role"),
        F.when(rule == 1, "").when(rule == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(rule == 0, 0).when(rule == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query("op13_simhash")
def op13(spark: SparkSession, path: str) -> DataFrame:
    """Near duplicates by fingerprints of three-word shingles that differ in two bits at most."""
    return simhash.linked(table(spark, path, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
