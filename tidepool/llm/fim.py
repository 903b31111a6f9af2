"""Fill-in-middle transformation over an index of distinct texts.

A text is a row of units: a word with the white space before it, or white space at its end. The index has one row for each
distinct text with its unit ends as an Elias-Fano list: of every end, in code points, the low bits stand packed in one array,
the high bits as gaps in a bit vector, where the end of unit i is found by selecting its i-th one. Documents meet their text by
digest, and two cuts are drawn from the document's id and looked up in the list; so the regular work over a text is done once,
however many copies there are, and a copy costs two look-ups and its own output.

Flow: (1) ids and digests of all rows, written. (2) Digests that more than one in ``HOT_SHARE`` of all rows have, fewer than
``HOT_SHARE`` of them, are broadcast and salted. (3) Texts are grouped by (digest, salt) with partial sets before the shuffle, so
a group's texts are compared by content: a digest with two texts stops the job. This is the only shuffle of texts, read twice.
(4) First the lists are made, leave their texts and are joined back to the ids, whose cuts are selected. (5) Then the cuts come to
the texts, which stay where they are, and outputs are cut and joined in Spark itself. A text of a hot digest has its list made
once for each salted part that it has rows in.

Defined cases: null or empty text is plain, has no units and gives an empty output; a text with a marker in it is plain, as it
couldn't be rebuilt; white space alone is one unit; repeated rows get a row each, with the same cuts; a null doc_id is drawn as
an empty id and stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import flat
from .scratch import cut

HOT_SHARE, PART_ROWS = 1024, 512
#: Every so many units the index keeps where to go on selecting.
STEP = 512
MARKS = ("<P>", "<S>", "<M>")


def unit_ends(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of all texts in code points, one text after the other, and how many each has."""
    raw, offs = flat.buffers(col)
    w = flat.words(col)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
    lasts = np.full(len(offs) - 1, -1, dtype=np.int64)
    some = np.flatnonzero(w.count)
    lasts[some] = w.end[w.first[1:][some] - 1]
    tail = np.flatnonzero((offs[1:] > offs[:-1]) & (lasts != offs[1:]))  # texts that end in white space
    at = np.concatenate([w.end, offs[1:][tail]])
    doc = np.concatenate([w.doc, tail])
    order = np.lexsort((at, doc))
    at, doc = at[order], doc[order]
    return chars[at] - chars[offs[doc]], np.bincount(doc, minlength=len(offs) - 1)


def packed(ends: np.ndarray) -> bytes:
    """An ascending list as Elias-Fano: bits of the low parts (1 byte), samples, low parts, high parts."""
    n = len(ends)
    if not n:
        return b""
    low_bits = max(int(ends[-1]) // n, 1).bit_length() - 1
    low = (ends[:, None] >> np.arange(low_bits)) & 1
    place = (ends >> low_bits) + np.arange(n)
    high = np.zeros(int(place[-1]) + 1, dtype=np.uint8)
    high[place] = 1
    parts = [np.uint8([low_bits]), place[::STEP].astype("<u8").view(np.uint8), np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), np.packbits(high, bitorder="little")]
    return b"".join(p.tobytes() for p in parts)


def selected(raw: bytes, n: int, i: int) -> int:
    """Element ``i`` of a list of ``n``."""
    low_bits, samples = raw[0], -(-n // STEP)
    at = 1 + 8 * samples
    first = int.from_bytes(raw[1 + 8 * (i // STEP) : 9 + 8 * (i // STEP)], "little")
    high_at = at + (n * low_bits + 7) // 8
    rest = i % STEP
    if rest:  # the next STEP ones lie between this sample and the next one
        end = int.from_bytes(raw[9 + 8 * (i // STEP) : 17 + 8 * (i // STEP)], "little") if i // STEP + 1 < samples else 8 * (len(raw) - high_at) - 1
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, (end >> 3) + 1 - (first >> 3), high_at + (first >> 3)), bitorder="little")
        place = int(np.flatnonzero(bits[first & 7 :])[rest]) + first
    else:
        place = first
    low = 0
    if low_bits:
        bit = i * low_bits
        low = int.from_bytes(raw[at + (bit >> 3) : at + ((bit + low_bits + 7) >> 3)], "little") >> (bit & 7) & ((1 << low_bits) - 1)
    return (place - i) << low_bits | low


def _lists(text: Column) -> Column:
    """n and the packed ends of a text column's values."""
    kind = pa.struct([("n", pa.int64()), ("ends", pa.binary())])

    @F.arrow_udf("n long, ends binary")
    def run(batches: pa.Array) -> pa.Array:
        out = []
        for b in flat.slices([pa.RecordBatch.from_arrays([batches], names=["text"])]):
            ends, n = unit_ends(b.column(0))
            cuts = np.concatenate([[0], np.cumsum(n)]).tolist()
            out.append(pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array([packed(ends[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], fields=list(kind)))
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return run(text)


def _places(*columns: Column) -> Column:
    """Of (n, ends, first, second): code points before unit ``first`` and before unit ``second``."""

    @F.arrow_udf("a long, b long")
    def run(n: pa.Array, ends: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        cols = [c.to_pylist() for c in (n, ends, first, second)]
        got = [tuple(selected(e, k, i - 1) if i else 0 for i in (x, y)) for k, e, x, y in zip(*cols, strict=True)]
        return pa.StructArray.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run(*columns)


def drawn(doc_id: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers of an id: the first 8-digit groups of a digest."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, text, output.

    ``rate`` of 100 texts are cut in three, of these ``spm`` of 100 with the suffix first (spm), the others prefix first (psm)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    ids = cut(docs.select("doc_id", "digest"), "ids")
    hot = ids.groupBy("digest").agg(F.count("*").alias("rows")).where(F.col("rows") * HOT_SHARE > ids.count())
    hot = F.broadcast(hot.select("digest", F.ceil(F.col("rows") / PART_ROWS).alias("parts")))

    def salted(df: DataFrame) -> DataFrame:
        return df.join(hot, "digest", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0))).drop("parts")

    index = salted(docs).groupBy("digest", "salt").agg(F.collect_set("text").alias("texts"))
    one = F.when(F.size("texts") == 1, F.get("texts", F.lit(0))).otherwise(F.raise_error(F.lit("two texts have one digest")))
    index = index.select("digest", "salt", one.alias("text"))
    marked = F.lit(False)
    for m in MARKS:
        marked = marked | F.contains("text", F.lit(m))
    lists = index.select("digest", "salt", marked.alias("marked"), _lists(F.col("text")).alias("list")).select("digest", "salt", "marked", "list.n", "list.ends")

    n, h = F.col("n"), drawn(F.col("doc_id"), seed)
    draws = lists.join(salted(ids).hint("shuffle_hash"), ["digest", "salt"]).withColumns({f"h{i + 1}": c for i, c in enumerate(h)})
    plain = (n == 0) | F.col("marked") | (F.col("h3") % 100 >= rate)
    draws = draws.withColumns({"form": F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"), "i": F.col("h1") % (n + 1), "j": F.col("h2") % (n + 1)})
    cuts = draws.select("digest", "salt", "doc_id", "n", "form", _places(n, F.col("ends"), F.least("i", "j"), F.greatest("i", "j")).alias("at"))

    rows = index.join(cuts.hint("shuffle_hash"), ["digest", "salt"])
    a, b = F.col("at.a").cast("int"), F.col("at.b").cast("int")
    part = lambda start, length: F.substring(F.col("text"), start, length)
    prefix, middle, suffix = part(F.lit(1), a), part(a + 1, b - a), part(b + 1, F.char_length("text"))
    p, s, m = (F.lit(x) for x in MARKS)
    out = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    known = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(known, F.col("at.a")).alias("prefix_chars"), F.when(known, F.col("at.b") - F.col("at.a")).alias("middle_chars"), "text", out.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The parts hold no marker, so each marker stands once."""
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1) if a else output, b, 1)
    p, s, m = MARKS
    middle = F.substring_index(output, m, -1)
    psm = F.concat(F.substring(between("", s), len(p) + 1, 2**31 - 1), middle, between(s, m))
    spm = F.concat(between(p, m), middle, F.substring(between("", p), len(s) + 1, 2**31 - 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame, **params) -> DataFrame:
    """``transform`` with output_sha256 and restored_sha256 in place of the texts."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    rows = transform(docs, **params)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
