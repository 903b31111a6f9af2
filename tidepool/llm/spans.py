"""Substring dedup by sliding sentence spans.

A text is cut into sentences at line ends and after ".", "!" or "?", and further after words that a hash picks, so that
the pieces of a long sentence are the same wherever a passage stands. With ``gap`` these are the words whose hash is the
(last) least of any ``gap`` words in a row: every ``gap`` words have a cut, and cuts inside a passage depend on nothing
outside it. Without, they are one in ``clause``, at any distance. From every sentence a span runs over the fewest
consecutive sentences (two at least) that have ``min_words`` words together; with ``gap`` such a span also ends at every
sentence. Spans are hashed (words only: A-Z lowered, white space ignored) and joined globally; of equal spans the first
by (doc_id, place) stays, and every sentence that any other one covers is removed from its text with the white space
behind it.

With ``gap`` a repeated passage of ``min_words`` + 2 * ``gap`` - 1 words or more is found wherever it stands, whatever
its sentences, and no more than ``gap`` words at its start and ``gap`` - 1 at its end stay behind. A shorter one may be
missed unless it starts and ends where sentences do.

Flow: one pass counts span hashes (map-side combined); a second keeps (hash, doc_id, place) of those that occur twice or
more; their first places are joined to them to flag the others; the flags of a document meet its text in one more join.
Hashes that hold more than one in ``HOT_SHARE`` of these rows (so there are fewer of them than that) are salted in the
first of these joins and broadcast in the second, so that a passage in a third of all documents isn't one task's work.
A span recomputed from the text must have the flagged hash, so rows that share a doc_id never get each other's cuts.

Defined cases: null or empty text has no sentence and comes back as it is; texts with fewer than ``min_words`` words
have no span; rows with the same doc_id and text count as one occurrence and are treated alike; rows without a doc_id
come first, so they lose no span and others lose those they share with them; an empty table gives an empty result; other columns are ignored by :func:`dedup_spans` and kept by :func:`without_repeats`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .scratch import cut

MIN_WORDS, MIN_SENTENCES, CLAUSE = 25, 2, 8
GAP = 8
#: A hash with more than HOT_ROWS and more than one in HOT_SHARE of all repeated spans is dealt over SALTS tasks.
HOT_SHARE, HOT_ROWS, SALTS = 4096, 4096, 64


def least_of_any(h: np.ndarray, doc: np.ndarray, gap: int) -> np.ndarray:
    """Words whose hash is the last least one of some ``gap`` consecutive words of their text."""
    n = len(h)
    room = np.ones(n, dtype=np.int64)
    left, right = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    for k in range(1, min(gap, n)):
        same = doc[k:] == doc[:-k]
        left[:k], right[n - k :] = False, False
        left[k:] &= same & (h[:-k] >= h[k:])
        right[: n - k] &= same & (h[k:] > h[:-k])
        room += left
        room += right
    return room >= gap


def sentences(col: pa.Array, clause: int, gap: int = 0):
    """Words of the texts, and of each sentence: first word, end word, text."""
    w = flat.words(col)
    n = len(w.hash)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return w, none, none, none
    last = w.low[w.end - 1]
    lines = np.concatenate([[0], np.cumsum(w.low == 10)])
    final = np.ones(n, dtype=bool)
    final[:-1] = (w.doc[1:] != w.doc[:-1]) | (lines[w.start[1:]] > lines[w.end[:-1]]) | np.isin(last[:-1], np.frombuffer(b".!?", dtype=np.uint8))
    final |= least_of_any(w.hash, w.doc, gap) if gap else w.hash % flat.U(clause) == 0
    start = np.flatnonzero(np.concatenate([[True], final[:-1]]))
    return w, start, np.append(start[1:], n), w.doc[start]


def spans(col: pa.Array, min_words: int, min_sentences: int, clause: int, gap: int = 0):
    """(text, sentence within it, end sentence within it, hash) of every span, and the sentences."""
    w, start, end, doc = sentences(col, clause, gap)
    n = len(start)
    texts = len(w.first) - 1
    head = np.searchsorted(doc, np.arange(texts + 1))
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return (none, none, none, np.zeros(0, np.uint64)), w, start, end, head
    # the last sentence of the span: the first whose end is far enough
    to = np.searchsorted(end, start + min_words, "left")
    to = np.maximum(to, np.arange(n) + min_sentences - 1)
    on = np.flatnonzero(to < head[doc + 1])
    if gap:
        # the first sentence of the span that ends here: the last that starts far enough before
        back = np.minimum(np.searchsorted(start, end - min_words, "right") - 1, np.arange(n) - min_sentences + 1)
        last = np.flatnonzero((back >= head[doc]) & (to[np.maximum(back, 0)] != np.arange(n)))
        on, to = np.concatenate([on, back[last]]), np.concatenate([to[on], last])
        order = np.argsort(on, kind="stable")
        on, to = on[order], to[order]
    else:
        to = to[on]
    pw, inv = flat._pow(len(w.hash) + 1)
    total = np.zeros(len(w.hash) + 1, dtype=np.uint64)
    np.cumsum(w.hash * pw[: len(w.hash)], out=total[1:])
    h = flat.mix((total[end[to]] - total[start[on]]) * inv[start[on]] ^ flat.mix((end[to] - start[on]).astype(np.uint64)))
    return (doc[on], on - head[doc[on]], to + 1 - head[doc[on]], h), w, start, end, head


def _emit(*shape):
    schema = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])

    def run(batches):
        for b in flat.slices(batches):
            (doc, place, _, h), *_ = spans(b.column("text"), *shape)
            ids = b.column("doc_id").take(pa.array(doc, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids, pa.array(place.astype(np.int32))], schema=schema)

    return run


def _remove(*shape):
    schema = pa.schema([("row", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())])

    def run(batches):
        for b in flat.slices(batches):
            (doc, place, to, h), w, start, end, head = spans(b.column("text"), *shape)
            raw, offs = flat.buffers(b.column("text"))
            hits = b.column("hits").to_pylist()
            first = np.searchsorted(doc, np.arange(b.num_rows + 1))
            gone = np.zeros(len(start) + 1, dtype=np.int64)
            for i, hit in enumerate(hits):
                if not hit:
                    continue
                known = {(x["place"], x["hash"]) for x in hit}
                for k in range(first[i], first[i + 1]):
                    if (int(place[k]), int(h[k].view(np.int64))) in known:
                        gone[head[i] + place[k]] += 1
                        gone[head[i] + to[k]] -= 1
            cover = np.cumsum(gone)[:-1] > 0
            texts = b.column("text").to_pylist()
            removed = np.zeros(b.num_rows, dtype=np.int64)
            for i, hit in enumerate(hits):
                own = cover[head[i] : head[i + 1]]
                removed[i] = own.sum()
                if not removed[i]:
                    continue
                # a sentence reaches to the next one's first word
                edge = np.append(w.start[start[head[i] : head[i + 1]]], offs[i + 1])
                edge[0] = offs[i]
                texts[i] = b"".join(raw[a:z].tobytes() for a, z, g in zip(edge[:-1], edge[1:], own, strict=True) if not g).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(np.diff(head), pa.int64()), pa.array(removed)], schema=schema)

    return run


def repeated_places(docs: DataFrame, *shape) -> DataFrame:
    """(doc_id, place, hash) of every span that isn't the first of its kind."""
    found = docs.select("doc_id", "text").mapInArrow(_emit(*shape), "hash long, doc_id long, place int")
    often = cut(found.groupBy("hash").count().where("count > 1"), "often")
    total = often.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(often.where((F.col("count") > HOT_ROWS) & (F.col("count") * HOT_SHARE > total)).select("hash", F.lit(True).alias("hot")))  # fewer than HOT_SHARE rows
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "place"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = often.join(hot, "hash", "left").select("hash", F.explode(salts).alias("salt"))
    dealt = found.join(hot, "hash", "left").select("hash", "doc_id", "place", salt.alias("salt"))
    again = cut(dealt.join(keys, ["hash", "salt"], "left_semi").drop("salt"), "again")
    first = cut(again.groupBy("hash").agg(F.min(F.struct("doc_id", "place")).alias("first")), "first")
    firsts = again.join(F.broadcast(first.join(hot, "hash", "left_semi")), "hash").unionByName(again.join(hot, "hash", "left_anti").join(first, "hash"))
    return firsts.where(F.struct("doc_id", "place") > F.col("first")).select("doc_id", "place", "hash").distinct()


def dedup_spans(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES, clause: int = CLAUSE, gap: int = 0) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text without repeated spans, n_sentences, n_removed."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    flags = repeated_places(texts, min_words, min_sentences, clause, gap)
    hits = flags.groupBy("doc_id").agg(F.collect_list(F.struct("place", "hash")).alias("hits"))
    full = texts.join(hits, "doc_id", "left").select(F.col("doc_id").alias("row"), "text", "hits")
    out = full.mapInArrow(_remove(min_words, min_sentences, clause, gap), "row long, text string, n_sentences long, n_removed long")
    return out.withColumnRenamed("row", "doc_id")


def without_repeats(docs: DataFrame, **shape) -> DataFrame:
    """``docs`` with all its columns, repeated spans removed from text, and n_chars (if there) counted anew."""
    shape = {"min_words": MIN_WORDS, "min_sentences": MIN_SENTENCES, "clause": CLAUSE, "gap": 0} | shape
    keyed = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    flags = repeated_places(keyed, *shape.values())
    hits = flags.groupBy("doc_id").agg(F.collect_list(F.struct("place", "hash")).alias("_hits"))
    full = keyed.join(hits, "doc_id", "left")
    names = [f.name for f in docs.schema]
    rest = [n for n in names if n != "text"]
    schema = full.select(*names).schema
    remove = _remove(*shape.values())

    def run(batches):
        for b in flat.slices(batches):
            plain = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), b.column("_hits")], names=["row", "text", "hits"])
            new = pa.concat_arrays([x.column("text") for x in remove([plain])])
            yield pa.RecordBatch.from_arrays([new if n == "text" else b.column(n) for n in names], names=names)

    out = full.select(*names, "_hits").mapInArrow(run, schema)
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(schema["n_chars"].dataType))
    return out.select(*names)
