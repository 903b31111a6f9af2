"""Text corpora: messages from several formats, markup stripping, topic tags, chunks and a manifest.

The vocabulary is a parameter; the default is neutral.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import stable_id, strip_markup, topic_pattern
from .chains import starts
from .scale import running
from .written import written

TOPICS = {"motion": ["the", "over", "with"], "travel": ["la", "de", "city trip"], "work": ["is", "project plan", "task"], "home": ["der", "die", "house"]}
EXTENSIONS = ("json", "jsonl", "txt", "md", "html", "htm")
# Fields of a message in order of precedence, and role markers of plain text.
TEXT_FIELDS = ("text", "content", "message", "body", "text_content")
ROLE_FIELDS = ("role", "author")
TIME_FIELDS = ("timestamp", "created_at", "date", "time")
CONVERSATION_FIELDS = ("conversation_id", "conv_id", "thread_id", "chat_id")
MARKERS = "User|Assistant|Human|AI|System|You|Me"


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Whole files below ``path`` of the known extensions: source_file, detected_format, content. Bytes that aren't UTF-8
    become replacement characters; empty files are passed over, as Spark does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    kind = F.when(ext == "json", "json").when(ext == "jsonl", "jsonl").when(ext.isin("html", "htm"), "html").otherwise("plaintext")
    return files.where(ext.isin(*EXTENSIONS)).select(F.col("path").alias("source_file"), kind.alias("detected_format"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))


def _field(v: Column, names) -> Column:
    """The first present key of a JSON object as text, even if its value is null."""
    keys = F.json_object_keys(v)
    out = F.lit(None).cast("string")
    for n in reversed(names):
        out = F.when(F.array_contains(keys, n), F.get_json_object(v, f"$.{n}")).otherwise(out)
    return out


def normalise(messages: DataFrame, column: str = "message") -> DataFrame:
    """JSON objects (or plain strings) in ``column`` as text, role, timestamp, conversation_id."""
    v = F.col(column)
    is_object = F.json_object_keys(v).isNotNull()
    fields = {n: F.when(is_object, _field(v, names)) for n, names in (("text", TEXT_FIELDS), ("role", ROLE_FIELDS), ("timestamp", TIME_FIELDS), ("_conv", CONVERSATION_FIELDS))}
    out = messages.withColumns(fields).withColumn("text", F.when(is_object, F.col("text")).otherwise(v)).withColumn("role", F.coalesce("role", F.lit("unknown")))
    have = F.col("conversation_id") if "conversation_id" in messages.columns else F.lit(None).cast("string")
    return out.withColumn("conversation_id", F.coalesce("_conv", have)).drop("_conv", column)


def _elements(json: Column, path: str) -> Column:
    """Elements of a JSON array as JSON text (strings as plain text)."""
    part = F.get_json_object(json, path) if path != "$" else json
    return F.from_json(part, "array<string>")


def json_messages(files: DataFrame) -> DataFrame:
    """Messages of whole JSON files: a list, {messages}, {conversations: [{id, messages}]}, or one other object."""
    j = F.trim(F.col("content"))
    conversations = F.flatten(F.transform(_elements(j, "$.conversations"), lambda c: F.transform(F.coalesce(_elements(c, "$.messages"), F.array().cast("array<string>")), lambda m: F.struct(m.alias("message"), F.coalesce(F.get_json_object(c, "$.id"), F.get_json_object(c, "$.conversation_id")).alias("conversation_id")))))
    alone = lambda a: F.transform(a, lambda m: F.struct(m.alias("message"), F.lit(None).cast("string").alias("conversation_id")))
    keys = F.json_object_keys(j)
    shaped = F.when(j.startswith("["), alone(_elements(j, "$"))).when(F.array_contains(keys, "messages"), alone(_elements(j, "$.messages"))).when(F.array_contains(keys, "conversations"), conversations).when(keys.isNotNull(), alone(F.array(j)))
    rows = files.where("detected_format = 'json'").select("source_file", "detected_format", F.posexplode(shaped).alias("message_index", "m")).select("source_file", "detected_format", "message_index", "m.message", "m.conversation_id")
    return normalise(rows)


def jsonl_messages(files: DataFrame) -> DataFrame:
    """One message a line; blank and malformed lines are skipped, the index is the physical line."""
    rows = files.where("detected_format = 'jsonl'").select("source_file", "detected_format", F.posexplode(F.split("content", "\n")).alias("message_index", "message"))
    return normalise(rows.where(F.trim("message") != "").where(F.json_object_keys("message").isNotNull()).withColumn("conversation_id", F.lit(None).cast("string")))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def split_roles(texts: DataFrame, text: str = "content", markers: str = MARKERS) -> DataFrame:
    """Plain text cut at role markers at line starts; fewer than two markers: the whole text as one message."""
    mark = "\u0001"
    marked = F.regexp_replace(F.col(text), rf"(?mi)^({markers}):\s*", f"{mark}$1{mark}")
    parts = F.split(marked, mark)
    turns = F.transform(F.sequence(F.lit(0), F.greatest((F.size(parts) / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.lower(F.get(parts, 2 * i + 1)).alias("role"), stripped(F.get(parts, 2 * i + 2)).alias("text")))
    whole = F.array(F.struct(F.lit("unknown").alias("role"), stripped(F.col(text)).alias("text")))
    rest = [c for c in texts.columns if c != text]
    return texts.select(*rest, F.posexplode(F.when(F.size(parts) >= 5, turns).otherwise(whole)).alias("message_index", "m")).select(*rest, "message_index", "m.role", "m.text")


def messages(files: DataFrame, entities=None) -> DataFrame:
    """Records of all formats: source_file, detected_format, message_index, conversation_id, role, timestamp, text. Pages have every
    entity decoded as a browser does, ``&amp`` without semicolon too, or only the pairs ``entities``, literally."""
    none = F.lit(None).cast("string")
    plain = split_roles(files.where("detected_format = 'plaintext'")).withColumns({"conversation_id": none, "timestamp": none})
    pages = files.where("detected_format = 'html'").select("source_file", "detected_format", F.lit(0).alias("message_index"), (strip_markup(F.col("content"), every_entity=True) if entities is None else strip_markup(F.col("content"), entities=entities)).alias("text"), F.lit("unknown").alias("role")).withColumns({"conversation_id": none, "timestamp": none})
    return json_messages(files).unionByName(jsonl_messages(files)).unionByName(plain).unionByName(pages)


def tag(texts: DataFrame, topics: dict[str, list[str]] | None = None, text: str = "text", least_chars: int = 10) -> DataFrame:
    """``texts`` of at least ``least_chars`` characters with a topic, as sorted topics and match_score (0.1 a match)."""
    topics = topics or TOPICS
    low = F.lower(F.col(text))
    counts = {t: F.regexp_count(low, F.lit(f"(?U){topic_pattern(w)}")) for t, w in sorted(topics.items())}
    rows = texts.where(F.length(F.col(text)) >= least_chars).withColumn("_n", F.array(*[F.struct(F.lit(t).alias("topic"), c.alias("n")) for t, c in counts.items()]))
    rows = rows.withColumn("topics", F.transform(F.filter("_n", lambda x: x["n"] > 0), lambda x: x["topic"])).where(F.size("topics") > 0)
    return rows.withColumn("match_score", F.round(F.aggregate("_n", F.lit(0), lambda a, x: a + x["n"]) / 10.0, 2)).drop("_n")


def with_ids(records: DataFrame, source: str = "source_file", place: str = "message_index") -> DataFrame:
    return records.withColumn("record_id", stable_id(F.concat_ws("_", F.col(source), F.col(place).cast("string"))))


def histogram(records: DataFrame) -> DataFrame:
    return records.select(F.explode("topics").alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))


def json_chars(df: DataFrame) -> Column:
    """Characters of a row as a JSON object with a space after each comma and colon, nulls written out."""
    n = F.length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})) + 2 * len(df.columns) - 1
    for c in (c for c, kind in df.dtypes if kind.startswith("array")):
        n = n + F.coalesce(F.greatest(F.size(c) - 1, F.lit(0)), F.lit(0))
    return n


def chunked(records: DataFrame, order: list[str], max_chars: int, width: int | None = None) -> DataFrame:
    """``records`` with size, its JSON's characters and ten, and chunk_id: greedy over all records in ``order``; a record that
    would overflow starts a new chunk, one that is too large has its own.

    Prefix sums of the sizes, taken by the first column of ``order`` (a file, say) and carried on, give every record's next chunk
    start, and ``chains.starts`` those that the first record leads to; no task works through all records."""
    first, *rest = order
    sized = records.withColumn("size", json_chars(records).cast("long") + 10).withColumn("_series", F.lit("all"))
    placed = written(running(written(sized, "sizes"), ["_series"], first, rest or order, {"_upto": F.col("size"), "_n": F.lit(1).cast("long")}), "places")
    at = F.col("_upto") - F.col("size")
    again = starts(placed.select(F.col("_series").alias("series"), (F.col("_n") - 1).alias("place"), at.alias("at"), F.col("_upto").alias("end"), (at + max_chars).alias("limit")), max_chars, width=width)
    marked = placed.join(again.select((F.col("place") + 1).alias("_n"), F.lit(1).cast("long").alias("_start")), "_n", "left")
    return running(marked, ["_series"], first, rest or order, {"chunk_id": F.coalesce("_start", F.lit(0))}).drop("_series", "_upto", "_n", "_start")


def chunk_list(kept: DataFrame, name: str = "chunk") -> DataFrame:
    """A row for each chunk: chunk_id, filename, record_count, char_size."""
    rows = kept.groupBy("chunk_id").agg(F.count("*").alias("record_count"), F.sum("size").alias("char_size"))
    return rows.select("chunk_id", F.format_string(f"{name}_%04d.json", "chunk_id").alias("filename"), "record_count", "char_size")


def failed_files(files: DataFrame) -> DataFrame:
    """Files that give no record because they can't be read as what they are: source_file, error. A JSON Lines file has its bad
    lines skipped and fails only if all of them are bad."""
    lines = F.filter(F.split("content", "\n"), lambda x: F.trim(x) != "")
    bad = F.when(F.col("detected_format") == "json", F.when(F.try_parse_json(F.col("content")).isNull(), F.lit("not JSON")))
    bad = bad.when(F.col("detected_format") == "jsonl", F.when(F.forall(lines, lambda x: F.json_object_keys(x).isNull()), F.lit("no line is a JSON object")))
    return files.where(F.trim("content") != "").select("source_file", bad.alias("error")).where("error is not null")


def manifest(files: DataFrame, records: DataFrame, kept: DataFrame, least_chars: int = 10) -> DataFrame:
    """One row: files, failed files, kept and dropped records (and those dropped for their length), topic counts, chunks.

    The lists behind the numbers, :func:`failed_files` and :func:`chunk_list`, are tables, as they grow with the corpus."""
    counts = histogram(kept).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", "n")))).alias("topic_counts"))
    short = F.col("text").isNull() | (F.length("text") < least_chars)
    single = [
        files.agg(F.count("*").alias("files")),
        failed_files(files).agg(F.count("*").alias("failed")),
        records.agg(F.count("*").alias("seen"), F.count_if(short).alias("dropped_short")),
        kept.agg(F.count("*").alias("kept"), *([F.count_distinct("chunk_id").alias("chunks")] if "chunk_id" in kept.columns else [])),
        counts,
    ]
    out = single[0]
    for row in single[1:]:  # single rows
        out = out.crossJoin(row)
    return out.withColumn("dropped", F.col("seen") - F.col("kept"))
