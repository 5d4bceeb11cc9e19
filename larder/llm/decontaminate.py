"""Benchmark decontamination by template canonicalisation.

Words are made canonical: numbers, measurement units and names become typed
placeholders (slots), other words lose case and outer punctuation. So a question
whose numbers or names were exchanged has the template of the original.

1. Windows of ``window`` canonical words of all benchmark items are hashed (an item
   with fewer words is one window). A bounded Bloom filter of the hashes is probed
   with every window of every document; hits go to a hash join with the item windows.
   A window with fewer than ``min_literals`` words that are not slots says little as a
   template: it is hashed with its values, and matches where the words are the same.
   Windows with a capitalised word that begins a sentence are also hashed in a second form
   in which it is a name, so that neither a subject's name nor a line break hides a copy.
   Windows that several items share don't open a match where they need not: an item's most
   shared windows are set aside as long as they cover too few of its words to condemn a
   document. Any match holds one of the others, its seeds; only seeds are joined by hash
   alone. So an opening that many items and documents share makes no row for every pair of
   them, and the windows set aside are looked up at their place on the diagonals of seeds.
2. Hits of one document and item on one diagonal (document place minus item place)
   are an aligned match. Slots must be consistent: a value of the item stands for
   one value in the document. Windows with a slot value that maps to two are dropped.
   This is judged for the hits in the first form alone, and for those in either form.
3. A document is contaminated by an item if the remaining windows of a diagonal cover
   ``share`` of the item's words, or ``long_match`` words.

Nulls, edges: NULL and empty texts have no windows. Rows of documents that repeat an
id are told apart by their text. Items with a NULL id or no windows match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.bloom import filter_words, probe, split_by_keys
from larder.llm.canonical import Words, canonical_words, enough
from larder.llm.common import bounded_batches, mix64, packed, utf8_column, written
from larder.llm.near_dedup import keyed

_UNIT_BYTES = 1 << 19       # text made canonical at a time


@dataclass(frozen=True)
class DecontaminationParams:
    window: int = 8
    min_literals: int = 4
    share: float = 0.5
    long_match: int = 13
    max_blocks: int = 1 << 18


def keyed_windows(words: Words, size: int, min_literals: int, exact: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, bool]]:
    """Places, keys, kinds of the slots (None: no slots, the words are the same) and whether it is the first form.

    ``exact``: mask of the places that have the exact key besides that of their template.
    """
    at, wh = words.windows(size, min_literals)
    rich = enough(words.kinds, size, min_literals)[at]
    yield at[rich], wh[rich], words.kinds, True
    yield at[~rich], wh[~rich], None, True
    yield *words.wide_templates(size, min_literals), words.wide, False
    if exact.any():
        at, wh = words.exact(size)
        more = rich & exact[at]
        yield at[more], wh[more], None, True


def item_windows(items: DataFrame, params: DecontaminationParams) -> DataFrame:
    """(item_id, words, size, pos, wh, wh2, item_slots, exact, item_first): all windows of all items.

    ``exact``: keyed by the words themselves; ``item_first``: in the first form.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = canonical_words([text.encode()])
                size = min(params.window, len(words.hashes))
                if not size:
                    continue
                poor = ~enough(words.wide, size, params.min_literals)
                for places, keys, kinds, first in keyed_windows(words, size, params.min_literals, poor):
                    for at, wh in zip(places.tolist(), keys.tolist(), strict=True):
                        slots = [] if kinds is None else words.slots(at, size, kinds)
                        out.append((item, len(words.hashes), size, at, wh, slots, kinds is None, first))
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            wh = np.array(columns[4], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int32()), pa.array(wh.view(np.int64)), pa.array(mix64(wh).view(np.int64)),
                 pa.array(columns[5], pa.list_(pa.string())), pa.array(columns[6], pa.bool_()), pa.array(columns[7], pa.bool_())],
                names=["item_id", "words", "size", "pos", "wh", "wh2", "item_slots", "exact", "item_first"])

    return (items.select(F.col("item_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
            .where("item_id IS NOT NULL").dropDuplicates().mapInArrow(
                run, "item_id bigint, words int, size int, pos int, wh bigint, wh2 bigint, item_slots array<string>, "
                     "exact boolean, item_first boolean"))


def with_seeds(windows: DataFrame, params: DecontaminationParams) -> DataFrame:
    """Adds ``seed``: false for an item's most shared windows, as long as all of these cover too few words for a match.

    A place adds at least one word to what the places before it cover, so an item has at
    most ``long_match`` such places.
    """
    shared = (windows.select("wh", "item_id").distinct().groupBy("wh").agg(F.count("*").alias("items")).where("items > 1"))
    order = Window.partitionBy("item_id").orderBy(F.desc("items"), "pos")
    places = (windows.join(shared, "wh").groupBy("item_id", "pos", "size", "words").agg(F.max("items").alias("items"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.long_match)
              .groupBy("item_id", "size", "words")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "pos"))), lambda r: r["pos"]).alias("places")))

    def covered(chosen: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(chosen, lambda p: F.sequence(p, p + F.col("size") - 1)))))

    def extended(chosen: Column, place: Column) -> Column:
        more = F.concat(chosen, F.array(place))
        few = (covered(more) < params.share * F.col("words")) & (covered(more) < params.long_match)
        return F.when(few, more).otherwise(chosen)

    aside = places.select("item_id", F.aggregate("places", F.array().cast("array<int>"), extended).alias("aside"))
    return windows.join(aside, "item_id", "left").withColumn(
        "seed", ~F.coalesce(F.array_contains("aside", F.col("pos")), F.lit(False))).drop("aside")


def units_of(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    """Canonical words of the batch's texts, about ``_UNIT_BYTES`` at a time, with the number of the first text."""
    buffer, offsets = utf8_column(batch, "text")
    at = 0
    while at < batch.num_rows:
        end = at + 1
        while end < batch.num_rows and offsets[end + 1] - offsets[at] <= _UNIT_BYTES:
            end += 1
        yield at, canonical_words([buffer[offsets[i]:offsets[i + 1]].tobytes() for i in range(at, end)])
        at = end


def document_hits(docs: DataFrame, words: np.ndarray, sizes: dict[int, bool], params: DecontaminationParams) -> DataFrame:
    """(__at, __fp, wh, at, doc_slots, doc_first): document windows that the filter passes (columns __at, __fp, text).

    ``sizes``: for each window size whether some item window of it is keyed by its words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, places, slots, firsts = [], [], [], [], []
            for offset, words in units_of(batch):
                for size, exact in sizes.items():
                    every = np.full(max(0, len(words.hashes) - size + 1), exact)
                    for at, wh, kinds, first in keyed_windows(words, size, params.min_literals, every):
                        for h in np.flatnonzero(probe(shared.value, wh.view(np.int64), mix64(wh).view(np.int64))).tolist():
                            text = int(np.searchsorted(words.bounds, at[h], side="right")) - 1
                            rows.append(offset + text)
                            places.append(int(at[h] - words.bounds[text]))
                            found.append(int(wh.view(np.int64)[h]))
                            slots.append([] if kinds is None else words.slots(int(at[h]), size, kinds))
                            firsts.append(first)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(found, pa.int64()),
                 pa.array(places, pa.int32()), pa.array(slots, pa.list_(pa.string())), pa.array(firsts, pa.bool_())],
                names=["__at", "__fp", "wh", "at", "doc_slots", "doc_first"])

    return docs.select("__at", "__fp", "text").mapInArrow(
        run, "__at bigint, __fp bigint, wh bigint, at int, doc_slots array<string>, doc_first boolean")


def leaks(docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """Contaminated (document, item) pairs of keyed documents: __at, __fp, item_id, item_words, covered, share, changed_slots."""
    bounded_batches(docs.sparkSession)
    windows = written(with_seeds(written(item_windows(items, params), "item-windows"), params), "item-seeds")
    sizes = {r["size"]: r["exact"] for r in                                         # at most ``window`` rows
             windows.groupBy("size").agg(F.max("exact").alias("exact")).orderBy("size").collect()}
    words = filter_words(windows, F.array("wh", "wh2"), params.max_blocks)
    hits = written(document_hits(docs, words, sizes, params).distinct(), "window-hits")
    diagonal = (F.col("at") - F.col("pos")).alias("diagonal")
    found = ["__at", "__fp", "wh", "at", "doc_slots", "doc_first", "item_id", "words", "size", "pos", "item_slots", "item_first"]
    same_slots = F.size("doc_slots") == F.size("item_slots")
    opened = written(hits.join(windows.where("seed").drop("wh2", "exact"), "wh").where(same_slots).select(found), "seed-hits")
    looked_up = (opened.select("__at", "__fp", "item_id", diagonal).distinct()
                 .join(windows.where("NOT seed").drop("wh2", "exact"), "item_id")
                 .withColumn("at", F.col("diagonal") + F.col("pos")).join(hits, ["__at", "__fp", "wh", "at"])
                 .where(same_slots).select(found))
    forms = F.when(F.col("item_first") & F.col("doc_first"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    matched = (opened.unionByName(looked_up)
               .withColumn("pairs", F.arrays_zip("item_slots", "doc_slots"))
               .withColumn("form", F.explode(forms))
               .groupBy("__at", "__fp", "item_id", diagonal, "form")
               .agg(F.first("words").alias("words"), F.collect_set(F.struct("pos", "size", "pairs")).alias("hits")))
    values = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["pairs"])))
    unclear = F.array_distinct(F.transform(F.filter("values", lambda p: F.size(F.filter(
        "values", lambda q: q["item_slots"] == p["item_slots"])) > 1), lambda p: p["item_slots"]))
    sound = F.filter("hits", lambda h: ~F.exists(h["pairs"], lambda p: F.array_contains("unclear", p["item_slots"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "sound", lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1)))))
    judged = (matched.withColumn("values", values).withColumn("unclear", unclear).withColumn("sound", sound)
              .where(F.size("sound") > 0).withColumn("covered", covered)
              .withColumn("changed", F.size(F.filter("values", lambda p: p["item_slots"] != p["doc_slots"]))))
    bad = judged.where((F.col("covered") >= params.share * F.col("words")) | (F.col("covered") >= params.long_match))
    best = bad.groupBy("__at", "__fp", "item_id").agg(F.max(F.struct("covered", "words", "changed")).alias("b"))
    return best.select("__at", "__fp", "item_id", F.col("b.words").alias("item_words"), F.col("b.covered").alias("covered"),
                       (F.col("b.covered") / F.col("b.words")).alias("share"), F.col("b.changed").alias("changed_slots"))


def contaminated_pairs(docs: DataFrame, items: DataFrame,
                       params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """doc_id, item_id, item_words, covered, share, changed_slots: one row per contaminated document and item.

    ``changed_slots`` counts the slot values that differ from the item's (0: the wording itself).
    """
    found = leaks(keyed(docs.select("doc_id", "text")), items, params)
    return found.select(F.when(F.col("__at") != (1 << 63) - 1, F.col("__at")).alias("doc_id"), "item_id", "item_words",
                        "covered", "share", "changed_slots")


def drop_contaminated(docs: DataFrame, items: DataFrame,
                      params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """``docs`` without the rows that some benchmark item contaminates; all columns stay."""
    source = packed(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("__at"), F.xxhash64("text").alias("__fp"),
        "text", "__all")
    found = written(leaks(source.drop("__all"), items, params).select("__at", "__fp").distinct(), "leaks")
    maybe, clean = split_by_keys(source.drop("text"), found, ["__at", "__fp"], params.max_blocks)
    return maybe.join(found, ["__at", "__fp"], "left_anti").select("__all.*").unionByName(clean.select("__all.*"))
