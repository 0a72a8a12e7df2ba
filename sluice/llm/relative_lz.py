"""Repeated passages by least-hash phrases of all documents and hashes of whole windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged, text_or_empty
from sluice.llm.textbatch import U, Words, window_hashes

#: Words of an indexed phrase.
PHRASE = 16


class Parse:
    """Windows and their phrases in a batch of texts.

    Every window of ``window`` words points to one of the phrases inside it: the one with the
    least hash, the leftmost of equals. Equal windows point to equal phrases at equal places, and
    neighbouring windows mostly to the same one, so that few phrases have to be indexed.
    """

    def __init__(self, texts: pa.Array, window: int):
        self.words = Words(texts)
        hashes = self.words.hashes()
        self.place, self.window = window_hashes(hashes, self.words.doc, window)
        phrase = min(PHRASE, window)
        at, value = window_hashes(hashes, self.words.doc, phrase)
        # Phrases start at every place where a window starts, and at the places inside it.
        spread = np.zeros(len(hashes), U)
        spread[at] = value
        count = window - phrase + 1
        if len(self.place):
            near = np.lib.stride_tricks.sliding_window_view(spread, count)
            step = 1 << 16
            offset = np.concatenate([near[self.place[i: i + step]].argmin(axis=1)
                                     for i in range(0, len(self.place), step)])
            self.phrase_at = self.place + offset
            self.phrase = spread[self.phrase_at]
        else:
            self.phrase_at, self.phrase = np.empty(0, np.int64), np.empty(0, U)
        self.first = np.searchsorted(self.place, self.words.first)


def _indexed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parse = Parse(batch.column("_text"), window)
            bodies = [parse.words.text(i) for i in range(len(batch))]
            phrases = []
            for i in range(len(batch)):
                own = slice(parse.first[i], parse.first[i + 1])
                phrases.append(parse.phrase[own][np.unique(parse.phrase_at[own], return_index=True)[1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(parse.words.count, pa.int64()),
                 pa.array([hashlib.sha256(b).hexdigest() for b in bodies]),
                 pa.array(phrases, pa.list_(pa.int64()))],
                names=["_key", "_words", "_sha", "_phrases"])
    return run


def _factors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parse = Parse(batch.column("_text"), window)
            known = batch.column("_repeated").to_pylist()
            keys, places, phrases, windows = [], [], [], []
            for i in range(len(batch)):
                own = slice(parse.first[i], parse.first[i + 1])
                hit = np.isin(parse.phrase[own].view(np.int64), np.array(known[i], np.int64))
                keys.append(np.full(hit.sum(), i))
                places.append(parse.place[own][hit] - parse.words.first[i])
                phrases.append(parse.phrase[own][hit])
                windows.append(parse.window[own][hit])
            if not keys:
                continue
            row = pa.array(np.concatenate(keys).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(row), batch.column("_many").take(row),
                 pa.array(np.concatenate(places).astype(np.int32)),
                 pa.array(np.concatenate(phrases).view(np.int64)),
                 pa.array(np.concatenate(windows).view(np.int64))],
                names=["_key", "_many", "_at", "_phrase", "_window"])
    return run


def _removed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("_text"))
            removed, spans, shas, kept_texts = [], [], [], []
            for i, (n, places) in enumerate(zip(words.count, batch.column("_places").to_pylist(), strict=True)):
                edge = np.zeros(n + 1, np.int64)
                at = np.unique(np.array(places, np.int64))
                edge[at] += 1
                np.subtract.at(edge, at + window, 1)
                gone = np.cumsum(edge)[:n] > 0
                kept = words.text(i, ~gone)
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)])
                shas.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(shas, pa.string()), pa.array(kept_texts, pa.string())],
                names=["_key", "_removed", "_spans", "_kept_sha", "_kept"])
    return run


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35,
                      keep_text: bool = False) -> DataFrame:
    """Duplicate spans of each document: doc_id, n_words, n_removed, spans, kept_sha256.

    A word is removed if a run of ``window`` words that covers it also starts anywhere else, in
    the same document or another. Every document is a reference block for all: its phrases (see
    ``Parse``) are indexed, and the windows that point to a phrase at more than one place of the
    corpus are kept; no Lempel-Ziv factors are built. They are then confirmed by the hash of all
    their words, and confirmed windows that touch make up a span. Hashes of phrase and window
    together have 128 bits. Equal texts are parsed once. ``spans`` has word places, ends
    exclusive; with ``keep_text``, ``kept`` has the remaining words joined by one space.

    Cases: a null or empty text has no words and loses none; texts shorter than a window lose
    none; repeated rows are copies and lose every word under a window; an empty table gives an
    empty one; other columns aren't in the result.
    """
    small_batches(docs.sparkSession)
    body = text_or_empty(text)
    read = docs.select(F.col(doc_id).alias("_id"), body.alias("_text"), F.xxhash64(body).alias("_k1"),
                       F.xxhash64(F.lit(7), body, F.length(body)).alias("_k2"))
    id_type = read.schema["_id"].dataType.simpleString()
    key = f"struct<id:{id_type},a:bigint,b:bigint>"
    named = read.select(F.struct(F.col("_id").alias("id"), F.col("_k1").alias("a"), F.col("_k2").alias("b")).alias("_key"),
                        F.col("_text").cast("binary").alias("_text"))
    parsed = staged(named.mapInArrow(
        _indexed(window), f"_key {key}, _words long, _sha string, _phrases array<long>"), "parsed")
    # Equal texts are one: the row with the smallest id stands for them.
    classes = staged(parsed.groupBy("_key.a", "_key.b").agg(
        F.min(F.struct(F.col("_key.id").isNull().alias("none"), F.col("_key.id").alias("id"))).alias("_rep"),
        F.count("*").alias("_copies"), F.first("_words").alias("_words")).select(
        "a", "b", F.col("_rep.id").alias("_rep"), "_copies", "_words"), "texts")
    own = classes.where(F.col("_words") >= window).select(
        F.col("a").alias("_a"), F.col("b").alias("_b"), "_rep", (F.col("_copies") > 1).alias("_many"))

    def of_class(frame: DataFrame, other: DataFrame):
        return ((frame["_key.a"] == other["_a"]) & (frame["_key.b"] == other["_b"])
                & frame["_key.id"].eqNullSafe(other["_rep"]))

    single = parsed.where(F.size("_phrases") > 0).select("_key", "_phrases")
    single = single.join(own, of_class(single, own)).select("_key", "_many", "_phrases")
    posted = single.where("not _many").select("_key", F.explode("_phrases").alias("_phrase"))
    every = single.select("_many", F.explode("_phrases").alias("_phrase"))
    repeated = every.groupBy("_phrase").agg(F.sum(F.when(F.col("_many"), 2).otherwise(1)).alias("_n")).where(
        "_n > 1").select("_phrase")
    hits = posted.join(repeated, "_phrase").groupBy("_key").agg(F.collect_set("_phrase").alias("_repeated"))
    # A text that occurs more than once is all repeated, but its windows are references as well.
    copied = single.where("_many").select("_key", F.array_distinct("_phrases").alias("_repeated"), F.lit(True).alias("_many"))
    hits = staged(hits.select("_key", "_repeated", F.lit(False).alias("_many")).union(copied), "factors")
    asked = hits.select(F.col("_key").alias("_asked"), "_repeated", "_many")
    texts = named.join(asked, _same(named["_key"], asked["_asked"])).select("_key", "_many", "_repeated", "_text")
    windows = texts.mapInArrow(
        _factors(window), f"_key {key}, _many boolean, _at int, _phrase long, _window long")
    windows = staged(windows, "windows")
    counted = windows.groupBy("_phrase", "_window").agg(
        F.sum(F.when(F.col("_many"), 2).otherwise(1)).alias("_n")).where("_n > 1").select("_phrase", "_window")
    confirmed = windows.where("not _many").join(counted, ["_phrase", "_window"]).groupBy("_key").agg(
        F.collect_list("_at").alias("_places"))
    confirmed = staged(confirmed, "confirmed")
    places = confirmed.select(F.col("_key").alias("_asked"), "_places")
    cut = named.join(places, _same(named["_key"], places["_asked"])).select("_key", "_text", "_places").mapInArrow(
        _removed(window), f"_key {key}, _removed long, _spans array<struct<start:long,end:long>>, "
                          "_kept_sha string, _kept string")
    if not keep_text:
        cut = cut.drop("_kept")
    cut = cut.dropDuplicates(["_key"]).select(F.col("_key").alias("_cut_key"), *[c for c in cut.columns if c != "_key"])
    many = classes.where(F.col("_copies") > 1).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    base = parsed.drop("_phrases")
    joined = base.join(many, (base["_key.a"] == many["_a"]) & (base["_key.b"] == many["_b"]), "left")
    joined = joined.join(cut, _same(joined["_key"], cut["_cut_key"]), "left")
    whole = F.col("_a").isNotNull() & (F.col("_words") >= window)
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    one_span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("_words").alias("end")))
    result = joined.select(
        F.col("_key.id").alias(doc_id), F.col("_words").alias("n_words"),
        F.when(whole, F.col("_words")).otherwise(F.coalesce("_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, one_span).otherwise(F.coalesce("_spans", no_spans)).alias("spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_kept_sha", "_sha")).alias("kept_sha256"),
        *([F.when(whole, F.lit("")).otherwise(F.col("_kept")).alias("kept"), F.col("_key")] if keep_text else []))
    if not keep_text:
        return result
    unchanged = named.select(F.col("_key").alias("_text_key"), F.col("_text").cast("string").alias("_body")).dropDuplicates(["_text_key"])
    body_words = F.array_join(F.array_remove(F.split("_body", r"[\x20\x09-\x0D]+"), ""), " ")
    return result.join(unchanged, _same(result["_key"], unchanged["_text_key"])).select(
        doc_id, "n_words", "n_removed", "spans", "kept_sha256", F.coalesce("kept", body_words).alias("kept"))


def _same(one, two):
    """Equal keys, ids compared null-safe."""
    return (one["a"] == two["a"]) & (one["b"] == two["b"]) & one["id"].eqNullSafe(two["id"])
