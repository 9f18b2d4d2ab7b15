"""Repeated passages by compacting a de Bruijn graph of word windows.

Every window of ``WINDOW`` consecutive words is an edge between the shorter word
runs at its two ends. Only repeated edges matter, and few windows are repeated:

1. *Anchors.* The least hash of the short grams of a window depends on its words
   only. Windows whose anchor occurs once in the corpus are not repeated; only
   anchors are shuffled to find that out.
2. *Edges.* The other windows meet by hash. The first occurrence of an edge (by
   doc_id, then place) is its source, the others are repeats. Each task keeps the
   first occurrence of what it has seen and reports the rest as local repeats, so
   a passage found everywhere reaches the shuffle once per task.
3. *Compaction.* A node with one repeated edge in and one out is no branch. Edges
   that meet in such a node, one behind the other in their source, form a path;
   paths that meet in one are joined to longer ones.
4. *Spans.* Repeats are laid over the paths by source coordinates: those that
   advance along the path and along their document alike are one span.

Windows are equal if their 64-bit hashes and the 32-bit hashes of the runs at
both ends are, so two different ones are never taken for equal in practice.

Defined cases: null text has no words; texts shorter than a window lose nothing;
rows with a null id lose nothing and repeat nothing; rows with one id are one
document: a window is a repeat only of an earlier place; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import batches, components, discard, gram_hashes, mixed, slices, stored, word_hashes

WINDOW, GRAM = 20, 6
_EDGE, _REPEAT, _LOCAL = 0, 1, 2
# ``code`` is four times the start; plus 1 if the edge was met again in its slice; plus 2 for a stretch of
# local repeats, whose length is in ``ends``. Four columns keep the rows short that are shuffled.
FOUND = "key bigint, doc_id bigint, code bigint, ends bigint"
RESOLVED = "kind int, doc_id bigint, start bigint, n bigint, ends bigint, src_id bigint, src_start bigint"


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``width`` values."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while 2 * have <= width:
        out, have = pick(out[:-have], out[have:]), 2 * have
    return pick(out[: len(values) - width + 1], out[width - have :]) if have < width else out


def _anchors_of(words: np.ndarray) -> np.ndarray:
    """The anchor of the window that begins at each word."""
    return _sliding(gram_hashes(words, GRAM), WINDOW - GRAM + 1, np.minimum)


def _chosen(words: np.ndarray) -> np.ndarray:
    """Hashes of the grams of one document that are the anchor of a window, once per place."""
    grams = gram_hashes(words, GRAM)
    least = _sliding(grams, WINDOW - GRAM + 1, np.minimum)
    if not len(least):
        return least
    edge = np.zeros(WINDOW - GRAM, dtype=np.uint64)
    return grams[_sliding(np.concatenate([edge, least, edge]), WINDOW - GRAM + 1, np.maximum) == grams]


def anchors(docs: DataFrame) -> DataFrame:
    """(anchor, doc_id, places) of every document."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            ids, found, places = [], [], []
            doc_ids = batch.column("doc_id").to_pylist()
            for first, _, raws in slices(batch.column("text").to_pylist(), lower=False):
                words, bounds = word_hashes(raws)
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    own, counts = np.unique(_chosen(words[a:b]), return_counts=True)
                    if len(own):
                        ids.append(np.full(len(own), doc_ids[first + i]))
                        found.append(own.view(np.int64))
                        places.append(counts)
            flat = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64))
            yield pa.record_batch([flat(found), flat(ids), flat(places)], names=["anchor", "doc_id", "places"])

    return docs.mapInArrow(run, "anchor bigint, doc_id bigint, places bigint")


def _candidates(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the windows with a repeated anchor: first occurrences of the slice, and stretches of local repeats."""
    for batch in batches(rows, 2048):
        batch = batch.take(pa.array(np.argsort(batch.column("doc_id").to_numpy(), kind="stable")))
        doc_ids, lists = batch.column("doc_id").to_numpy(), batch.column("anchors").to_pylist()
        for first, _, raws in slices(batch.column("text").to_pylist(), lower=False):
            words, bounds = word_hashes(raws)
            least, edges, nodes = _anchors_of(words), gram_hashes(words, WINDOW), gram_hashes(words, WINDOW - 1)
            at, docs = [], []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if b - a >= WINDOW:
                    own = np.flatnonzero(np.isin(least[a : b - WINDOW + 1], np.array(lists[first + i], dtype=np.int64).view(np.uint64)))
                    at.append(own + a)
                    docs.append(np.full(len(own), i))
            if not at or not sum(map(len, at)):
                continue
            at, doc = np.concatenate(at), np.concatenate(docs)
            start, doc_id = at - bounds[doc], doc_ids[first + doc]
            _, begin, which, times = np.unique(edges[at], return_index=True, return_inverse=True, return_counts=True)
            source = begin[which]
            again = (doc_id != doc_id[source]) | (start != start[source])
            keep = np.sort(begin)
            yield _found(edges[at][keep], doc_id[keep], start[keep] * 4 + (times[which[keep]] > 1), _ends(nodes, at[keep]))
            spot = np.flatnonzero(again)
            if len(spot):
                cut = np.flatnonzero((np.diff(spot) != 1) | (np.diff(at[spot]) != 1) | (np.diff(doc[spot]) != 0)) + 1
                heads = spot[np.concatenate([[0], cut])]
                sizes = np.diff(np.concatenate([[0], cut, [len(spot)]]))
                yield _found(mixed(doc_id[heads].astype(np.uint64)), doc_id[heads], start[heads] * 4 + 2, sizes)


def _ends(nodes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Short hashes of the runs at both ends of the windows, in one number: what precedes the last word, and what follows the first."""
    half = np.uint64(32)
    return (nodes[at] >> half << half) | (nodes[at + 1] >> half)


def _found(key, doc_id, code, ends) -> pa.RecordBatch:
    columns = [key.view(np.int64), doc_id, code, ends.view(np.int64)]
    return pa.record_batch([pa.array(np.asarray(c), pa.int64()) for c in columns], names=["key", "doc_id", "code", "ends"])


def _resolve(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, ends, doc_id and code: sources of repeated edges, repeats with their source, local repeats.

    The rows of the last key of a batch wait for the next one; there is one per task at most.
    """
    wait = None
    for batch in rows:
        if not batch.num_rows:
            continue
        if wait is not None:
            batch = pa.Table.from_batches([wait, batch]).combine_chunks().to_batches()[0]
        key = batch.column("key").to_numpy()
        end = int(np.searchsorted(key, key[-1]))
        wait = batch.slice(end)
        if end:
            yield _sorted_out(batch.slice(0, end))
    if wait is not None:
        yield _sorted_out(wait)


def _sorted_out(batch: pa.RecordBatch) -> pa.RecordBatch:
    c = {name: batch.column(name).to_numpy() for name in batch.schema.names}
    start, edge = c["code"] >> 2, c["code"] & 2 == 0
    key = np.stack([c["key"], c["ends"]])
    new = np.ones(len(edge), dtype=bool)
    new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0) | ~edge[1:] | ~edge[:-1]
    group = np.cumsum(new) - 1
    source = np.flatnonzero(new)[group]
    many = (np.bincount(group)[group] > 1) | (np.maximum.reduceat(c["code"] & 1, np.flatnonzero(new))[group] > 0)
    repeat = edge & ((c["doc_id"] != c["doc_id"][source]) | (start != start[source]))
    kind = np.where(edge, np.where(repeat, _REPEAT, _EDGE), _LOCAL).astype(np.int32)
    keep = ~edge | repeat | (new & many)
    columns = [kind, c["doc_id"], start, np.where(edge, 1, c["ends"]), np.where(edge & ~repeat, c["ends"], 0), c["doc_id"][source], start[source]]
    names = ["kind", "doc_id", "start", "n", "ends", "src_id", "src_start"]
    return pa.record_batch([pa.array(x[keep]) for x in columns], names=names)


def repeated_edges(docs: DataFrame) -> DataFrame:
    """Sources of the repeated windows, their repeats, and local repeats (see RESOLVED)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    marked = stored(anchors(docs), "repeats-anchors")
    repeated = marked.groupBy("anchor").agg(F.sum("places").alias("places")).where("places > 1").select("anchor")
    lists = marked.join(stored(repeated, "repeats-repeated"), "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    lists = stored(lists, "repeats-lists")
    discard(marked)
    found = docs.join(lists, "doc_id").mapInArrow(_candidates, FOUND)
    dealt = found.repartition("key").sortWithinPartitions("key", "ends", "doc_id", "code")
    out = stored(dealt.mapInArrow(_resolve, RESOLVED), "repeats-resolved")
    discard(lists)
    return out


def _nodes(edges: DataFrame) -> DataFrame:
    """The nodes with one repeated edge in and one out, with the sources of both."""
    into = edges.select(F.col("tail").alias("node"), F.col("doc_id").alias("in_id"), F.col("start").alias("in_start"), *_nulls("out_id", "out_start"))
    out = edges.select(F.col("head").alias("node"), *_nulls("in_id", "in_start"), F.col("doc_id").alias("out_id"), F.col("start").alias("out_start"))
    sums = [F.count("in_id").alias("n_in"), F.count("out_id").alias("n_out"), *(F.max(c).alias(c) for c in ("in_id", "in_start", "out_id", "out_start"))]
    return into.unionByName(out).groupBy("node").agg(*sums).where("n_in = 1 and n_out = 1").drop("n_in", "n_out")


def _nulls(*names: str) -> list:
    return [F.lit(None).cast("bigint").alias(n) for n in names]


LAID = "kind int, doc_id bigint, start bigint, n bigint, src_id bigint, src_start bigint, head bigint, tail bigint"


def _lay(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source: edges become stretches of paths, repeats along a stretch become spans.

    A stretch or span cut by the end of a batch goes on in the next row of the result.
    """
    names = ["kind", "doc_id", "start", "n", "src_id", "src_start", "head", "tail"]
    for batch in rows:
        if not batch.num_rows:
            continue
        c = {name: batch.column(name).fill_null(0).to_numpy() for name in ("src_id", "src_start", "order", "doc_id", "start", "head", "tail")}
        edges = np.flatnonzero(c["order"] == 0)
        bound = np.zeros(len(c["order"]) + 1, dtype=bool)
        bound[np.flatnonzero(c["order"] == 1)] = True  # the link of an edge follows it
        id_, at = c["src_id"][edges], c["src_start"][edges]
        new = np.ones(len(edges), dtype=bool)
        new[1:] = (id_[1:] != id_[:-1]) | (at[1:] != at[:-1] + 1) | ~bound[edges[:-1] + 1]
        heads = np.flatnonzero(new)
        if len(heads):
            lasts = np.append(heads[1:], len(edges)) - 1
            sizes = lasts - heads + 1
            columns = [np.full(len(heads), _EDGE, dtype=np.int32), id_[heads], at[heads], sizes, id_[heads], at[heads], c["head"][edges[heads]], c["tail"][edges[lasts]]]
            yield pa.record_batch([pa.array(x) for x in columns], names=names)
        again = np.flatnonzero(c["order"] == 2)
        if len(again):
            stretch = np.searchsorted(edges[heads], again, side="right") if len(heads) else np.zeros(len(again), dtype=np.int64)
            id_, at, src = c["doc_id"][again], c["start"][again], c["src_start"][again]
            order = np.lexsort([src, at - src, id_, stretch])
            id_, at, src, stretch, again = id_[order], at[order], src[order], stretch[order], again[order]
            new = np.ones(len(again), dtype=bool)
            new[1:] = (stretch[1:] != stretch[:-1]) | (id_[1:] != id_[:-1]) | (at[1:] - src[1:] != at[:-1] - src[:-1]) | (src[1:] > src[:-1] + 1)
            heads = np.flatnonzero(new)
            sizes = src[np.append(heads[1:], len(again)) - 1] - src[heads] + 1
            none = np.zeros(len(heads), dtype=np.int64)
            columns = [np.full(len(heads), _REPEAT, dtype=np.int32), id_[heads], at[heads], sizes, c["src_id"][again[heads]], src[heads], none, none]
            yield pa.record_batch([pa.array(x) for x in columns], names=names)


def compacted(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stretches and spans, nodes without a branch) of the repeated edges."""
    edges = resolved.where(F.col("kind") == _EDGE)
    edges = edges.withColumn("head", F.shiftrightunsigned("ends", 32)).withColumn("tail", F.col("ends").bitwiseAND(F.lit(0xFFFFFFFF)))
    nodes = stored(_nodes(edges.select("doc_id", "start", "head", "tail")), "repeats-nodes")
    straight = nodes.where("in_id = out_id and in_start + 1 = out_start").select(F.col("in_id").alias("src_id"), F.col("in_start").alias("src_start"), F.lit(1).alias("order"))
    columns = ["src_id", "src_start", "order", "doc_id", "start", "head", "tail"]
    laid = (
        edges.withColumn("order", F.lit(0)).select(*columns)
        .unionByName(straight, allowMissingColumns=True)
        .unionByName(resolved.where(F.col("kind") == _REPEAT).withColumn("order", F.lit(2)).drop("ends", "n", "kind"), allowMissingColumns=True)
    )
    laid = laid.repartition("src_id").sortWithinPartitions("src_id", "src_start", "order").mapInArrow(_lay, LAID)
    return stored(laid, "repeats-laid"), nodes


def paths(resolved: DataFrame) -> DataFrame:
    """(path, doc_id, start, n_words): the stretches of every maximal path, by source; ``path`` is its smallest source place."""
    laid, nodes = compacted(resolved)
    stretches = laid.where(F.col("kind") == _EDGE).withColumn("stretch", F.struct("doc_id", "start"))
    behind = stretches.join(nodes.select(F.col("node").alias("tail")), "tail").select(F.col("stretch").alias("a"), F.col("tail").alias("node"))
    links = behind.join(stretches.select(F.col("head").alias("node"), F.col("stretch").alias("b")), "node").select("a", "b")
    joined = components(links, "repeats-paths")
    path = F.coalesce("component", "stretch")
    named = stretches.join(joined, F.col("stretch") == F.col("node"), "left")
    return named.select(path.alias("path"), "doc_id", "start", (F.col("n") + WINDOW - 1).alias("n_words"))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n): stretches of ``n`` windows from ``start`` on that repeat an earlier place."""
    resolved = repeated_edges(docs)
    laid, _ = compacted(resolved)
    local = resolved.where(F.col("kind") == _LOCAL).select("doc_id", "start", "n")
    return laid.where(F.col("kind") == _REPEAT).select("doc_id", "start", "n").unionByName(local)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and text: the words no repeat covers, joined by single spaces."""
    docs = docs.select("doc_id", "text")
    found = spans(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = docs.join(stored(found, "repeats-spans"), F.col("doc_id").cast("bigint") == F.col("_id"), "left").select("doc_id", "text", "spans")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts, n_words, n_removed = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if own:
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(step, [s["start"] for s in own], 1)
                    np.add.at(step, [min(s["start"] + s["n"] + WINDOW - 1, len(words)) for s in own], -1)
                    covered = np.cumsum(step[:-1]) > 0
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, text string")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the words that stay."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
