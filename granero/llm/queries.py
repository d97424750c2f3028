"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm import chat, collocations, decontamination, language, linededup, nearcopies, onebit, packing, periods, prefixes, quality, token_files, toxicity
from granero.llm.shipping import shipped
from granero.llm.tokens import vocabulary_path
from granero.session import shared_folder, track

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = shipped(build)
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return QUERIES[build.__name__]

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/granero-tokens-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, folder, "documents"), path, vocabulary_path())
    track(spark, path)
    rows = token_files.with_starts(token_files.read_token_files(spark, path))
    return token_files.with_checksums(rows.select("doc_id", "start", "n_tokens", "ids"))


@query("""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM numbered),
keyed AS (
    SELECT r, doc_id, pos, line,
           translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.key = f.key GROUP BY r
""")
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = linededup.drop_frequent_lines(table(spark, folder, "documents"), min_docs=10, min_length=1)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), vocabulary_path(), capacity=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op7_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = nearcopies.near_copies(table(spark, folder, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").where("quality = 1").select("doc_id")


@query()
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.score(table(spark, folder, "documents"), trusted_ids(spark, folder))
    return judged.drop("r1", "r2")


@query()
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.train(docs.where(~held_out), "doc_id", "text", "lang")
    return language.predict(docs, model, "doc_id", "text", held_out.alias("held_out"))


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, model, "doc_id", "text", held_out.alias("held_out"))


@query()
def op6_one_bit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.nearest(table(spark, folder, "embeddings"), query_rule="pmod(vec_id, 20) = 0", k=20)


CONTROL_TEXT = "\\### Assistant: </turn> ok"  # of conversation -7, which holds the template's control strings


@query(r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
escaped AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body,
           replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS head
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""")
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    own = table(spark, folder, "conversations")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string"
    )
    turns = chat.canonical_turns(own).unionByName(extra)
    return chat.read_back(chat.format_conversations(turns))


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The given rule that makes the tail of a tenth of the documents periodic; null ids are left alone."""
    own = zlib.crc32(str(doc_id).encode())
    if doc_id is None or own % 10 or not words:
        return words
    rest = own // 10
    start = rest % len(words)
    period = 1 + (len(words) - start) // (3 + rest % 8)
    block = words[start : start + period]
    return words[:start] + (block * (len(words) // len(block) + 1))[: len(words) - start]


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = F.col("runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    columns = {
        "n_runs": F.size(runs).cast("long"), "start": -best["start"], "length": best["length"], "period": -best["period"],
        "exponent_milli": F.call_function("div", 1000 * best["length"], -best["period"]),
        "runs_sha256": F.sha2(F.array_join(line, "").cast("binary"), 256),
        "collapsed_sha256": F.sha2(F.col("collapsed").cast("binary"), 256),
    }
    return periods.periodic_runs(table(spark, folder, "documents"), columns, prepare=repeat_tail)


@query()
def op12_prefix_encoding(spark: SparkSession, folder: str) -> DataFrame:
    coded = prefixes.encode(table(spark, folder, "documents"), vocabulary_path(), with_text=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query()
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=100, top=2000)
