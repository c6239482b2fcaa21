"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Every whole text becomes its set of distinct word shingles, one signature and a
   fingerprint of the set. Texts with equal sets form a class with its least doc_id
   as representative; only representatives go on, so exact copies cost nothing more.
2. The forest: each tree orders the representatives by its own signature values.
   Range partitions hold a tree's order piecewise, so a region of many documents is
   spread over tasks. Neighbours that share the least prefix form a region; a region
   too crowded to compare is cut by longer prefixes. In a region or its pieces, documents
   are tied as candidates wherever two groups have documents with near sketches. What a
   cut or a partition border keeps apart is compared again through the first documents
   of the pieces' groups.
3. Candidate links form clusters. The members' texts are brought together in chunks of
   bounded size and compared exactly, by an inverted index over full sets, until the
   chunk is one group or every pair of groups is compared. Large clusters have several
   chunks, each with the cluster's first documents; whatever is not in the cluster's
   largest group then visits its other chunks, so no pair of groups stays uncompared.
4. Confirmed links give connected components.

Nothing is capped: crowded regions are cut deeper and large clusters are chunked; the
first documents of all pieces' groups are compared with each other, and so are the
chunks' groups. What is missed, for two documents at similarity exactly 0.8, less above:

* they share no prefix in any of the 16 trees: 0.0002 with prefix 4; where they are in
  different pieces of a region of over 2,048 texts that first documents don't tie, up to
  0.023 with prefix 7;
* their sketches, the same in every tree, agree in fewer than 40 of 64 values: 0.0004.

Words are runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z in lower case. Defined
results: a text with fewer words than a shingle is one shingle of all its words; one
without words, or null, has no shingles and is linked with nothing; repeated rows are
linked like copies; a null doc_id has a null component and is kept; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lags import row_ids
from .common import released, text_batches, texts_of, written
from .graph import components

TREES, LEAST_DEPTH, DEPTH = 16, 4, 7
VALUES = TREES * DEPTH
#: bytes of a sketch, one for each of the first values
SKETCH = 64
#: documents that a region may hold before longer prefixes cut it, and documents of a chunk
REGION, CHUNK, ANCHORS = 2048, 512, 8
_rng = np.random.default_rng(20_240_229)
_XOR = _rng.integers(0, 1 << 32, VALUES, np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 31, VALUES, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    s = h[:n]
    for k in range(1, size):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(s)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of VALUES permutations over a non-empty set."""
    h = _mix(shingles).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 1024):
        np.minimum(out, ((h[None, i : i + 1024] ^ _XOR) * _MUL).min(1), out=out)
    return out


def signatures(df: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, fingerprint, signature) of every whole text; the last two null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            count, prints, signs = [], [], []
            for text in texts:
                s = shingle_set(text, size)
                count.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signs.append(signature(s).astype(">u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "fingerprint", "signature"])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, n_shingles long, fingerprint binary, signature binary")


def _printed(df: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """(row, print): every row whole, with the fingerprint of its text's set."""
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            sets = (shingle_set(t, size) for t in texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())], names=["row", "print"])

    return rows.mapInArrow(released(run), T.StructType([T.StructField("row", df.schema), T.StructField("print", T.BinaryType())]))


PREFIX = 1 + 4 * LEAST_DEPTH
ROWS = "a long, b long, prefix binary, sketch binary"


def _ties(sketches: np.ndarray, near: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(pairs of rows as [a, b] arrays, group of each row): links that make the groups all near pairs would make.

    First documents gather those near them; then every row outside the largest group is
    compared with all rows of other groups, so no near pair of two groups is missed.
    """
    n = len(sketches)
    group = np.arange(n)
    rest = np.arange(n)
    links = []
    while len(rest):
        lead, rest = rest[0], rest[1:]
        if not len(rest):
            break
        close = (sketches[rest] == sketches[lead]).sum(1) >= near
        if close.any():
            links.append(np.stack([np.full(int(close.sum()), lead), rest[close]]))
            group[rest[close]] = lead
            rest = rest[~close]
    size = np.bincount(group, minlength=n)
    if not links or size.max() == n:
        return links, group
    for k in np.flatnonzero(group != size.argmax()).tolist():
        other = np.flatnonzero(group != group[k])
        met = other[(sketches[other] == sketches[k]).sum(1) >= near]
        if len(met):
            met = met[np.unique(group[met], return_index=True)[1]]
            links.append(np.stack([np.full(len(met), k), met]))
            group[np.isin(group, group[met])] = group[k]
    return links, group


def _region(keys: list[bytes], sketches: np.ndarray, near: int, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ties of one region in its order, as of _ties; a crowded region is cut where longer prefixes differ, as deep as it takes."""
    if len(keys) <= REGION or depth == DEPTH:
        return _ties(sketches, near)
    links: list[np.ndarray] = []
    group = np.empty(len(keys), np.int64)
    end = 1 + 4 * (depth + 1)
    edges = [0, *(i for i in range(1, len(keys)) if keys[i][:end] != keys[i - 1][:end]), len(keys)]
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        inner, group[i:j] = _region(keys[i:j], sketches[i:j], near, depth + 1)
        links += [x + i for x in inner]
        group[i:j] += i
    # the pieces' first documents tie together what the cuts kept apart
    first = np.unique(group, return_index=True)[1]
    inner, of = _ties(sketches[first], near)
    links += [first[x] for x in inner]
    return links, of[np.unique(group, return_inverse=True)[1]]


def candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): candidate links between representatives, from the sorted orders of all trees."""
    # 3.5 standard deviations below the threshold
    near = int(np.floor(SKETCH * (threshold - 3.5 * (threshold * (1 - threshold) / SKETCH) ** 0.5)))

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = batch.column(1).to_pylist()
            values = np.frombuffer(b"".join(signs), np.uint8).reshape(-1, VALUES, 4)
            sketches = [x.tobytes() for x in np.ascontiguousarray(values[:, :SKETCH, 3])]
            for i in range(0, len(signs), 2048):
                part, ids, sk = signs[i : i + 2048], batch.column(0).slice(i, 2048), sketches[i : i + 2048]
                for tree in range(TREES):
                    head, start = bytes([tree]), 4 * DEPTH * tree
                    keys = [head + s[start : start + 4 * DEPTH] for s in part]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), ids, pa.array(sk, pa.binary())], names=["key", "id", "sketch"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        ids: list[np.ndarray] = []
        sketches: list[np.ndarray] = []
        links: list[tuple[np.ndarray, np.ndarray]] = []
        at_border = True

        def region(k: list[bytes], i: np.ndarray, s: np.ndarray, border: bool) -> Iterator[pa.RecordBatch]:
            ties, group = _region(k, s, near, LEAST_DEPTH)
            links.extend((i[x[0]], i[x[1]]) for x in ties)
            if border:
                leads = np.unique(group, return_index=True)[1].tolist()
                n = len(leads)
                yield pa.RecordBatch.from_arrays([pa.array(i[leads]), pa.nulls(n, pa.int64()), pa.array([k[x][:PREFIX] for x in leads], pa.binary()), pa.array([s[x].tobytes() for x in leads], pa.binary())], names=["a", "b", "prefix", "sketch"])

        def flush() -> Iterator[pa.RecordBatch]:
            if links:
                a, b = (np.concatenate(x) for x in zip(*links, strict=True))
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                links.clear()
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.binary()), pa.nulls(pairs.shape[1], pa.binary())], names=["a", "b", "prefix", "sketch"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys += batch.column(0).to_pylist()
            ids.append(batch.column(1).to_numpy())
            sketches.append(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH))
            edges = [i for i in range(1, len(keys)) if keys[i][:PREFIX] != keys[i - 1][:PREFIX]]
            if not edges:
                continue
            i, s = np.concatenate(ids), np.concatenate(sketches)
            for x, y in zip([0, *edges[:-1]], edges, strict=True):
                if y - x > 1 or at_border:
                    yield from region(keys[x:y], i[x:y], s[x:y], at_border)
                at_border = False
            keys, ids, sketches = keys[edges[-1] :], [i[edges[-1] :]], [s[edges[-1] :]]
            if len(links) > 10_000:
                yield from flush()
        if keys:
            yield from region(keys, np.concatenate(ids), np.concatenate(sketches), True)
        yield from flush()

    def rejoin(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["a"].to_numpy()
        sketches = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        order = np.argsort(ids, kind="stable")
        ids, sketches = ids[order], sketches[order]
        a, b = np.concatenate([np.empty((2, 0), np.int64), *(ids[x] for x in _ties(sketches, near)[0])], axis=1)
        return pa.table({"a": a, "b": b})

    rows = classes.select(F.col("node").alias("id"), "signature").mapInArrow(released(orders), "key binary, id long, sketch binary")
    rows = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    # what a task finds is little: rebalanced, it takes a few files instead of one a task
    found = written(rows.mapInArrow(released(scan), ROWS).hint("rebalance"), "forest")
    cut = found.filter("prefix is not null").select("a", "prefix", "sketch").dropDuplicates(["a", "prefix"]).groupBy("prefix").applyInArrow(rejoin, "a long, b long")
    return found.filter("b is not null").select("a", "b").unionByName(cut.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).filter("a <> b").distinct()


def _links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Confirmed links that make the same groups as all links between the sets would.

    Every set outside the largest group so far is compared with all others through
    an inverted index, so no link between two groups is missed.
    """
    m = len(ids)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    tails = np.r_[heads[1:], len(flat)]
    distinct = flat[heads]
    group = np.arange(m)
    out: list[tuple[int, int]] = []
    done = np.zeros(m, bool)
    while True:
        groups, counts = np.unique(group, return_counts=True)
        if len(groups) == 1:
            return out
        todo = np.flatnonzero(~done & (group != groups[counts.argmax()]))
        if not len(todo):
            return out
        for k in todo[:1].tolist():
            done[k] = True
            at = np.searchsorted(distinct, sets[k])
            spans = tails[at] - heads[at]
            index = np.repeat(heads[at] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(int(spans.sum()))
            common = np.bincount(owner[index], minlength=m)
            linked = np.flatnonzero((100 * common >= percent * (size + size[k] - common)) & (group != group[k]))
            for j in linked.tolist():
                if group[j] != group[k]:
                    out.append((ids[k], ids[j]))
                    group[group == group[j]] = group[k]


def _visit(visitors: list[tuple[int, int, np.ndarray]], ids: list[int], groups: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Confirmed links of visitors (id, group, set) with the residents of a chunk: one for each other group that a visitor is linked with."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    of = np.array(groups)
    out = []
    for i, group, s in visitors:
        a, b = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        span = b - a
        common = np.bincount(owner[np.repeat(a - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))], minlength=len(sets))
        linked = np.flatnonzero((100 * common >= percent * (size + len(s) - common)) & (of != group))
        out += [(i, ids[k]) for k in linked[np.unique(of[linked], return_index=True)[1]].tolist()]
    return out


def _compare(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): confirmed links within each value of ``chunk``; rows are (chunk, id, text, visitor, grp).

    Without visitors all of a chunk is compared; with visitors they are compared with the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: str | None = None
        held: dict[int, tuple[int, np.ndarray]] = {}
        visitors: list[tuple[int, int, np.ndarray]] = []
        found: list[tuple[int, int]] = []

        def finish() -> None:
            ids, groups, sets = list(held), [g for g, _ in held.values()], [s for _, s in held.values()]
            if visitors and held:
                found.extend(_visit(visitors, ids, groups, sets, percent))
            elif not visitors and len(held) > 1:
                found.extend(_links(ids, sets, percent))
            visitors.clear()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])
            found.clear()
            return batch

        for part, texts in text_batches(batches):
            for c, i, text, visitor, group in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                if c != chunk:
                    finish()
                    chunk, held = c, {}
                if visitor:
                    visitors.append((i, group, shingle_set(text, size)))
                    if len(visitors) == CHUNK and held:  # visitors come last, and in any number
                        found += _visit(visitors, list(held), [g for g, _ in held.values()], [s for _, s in held.values()], percent)
                        visitors.clear()
                        visitors.append((i, group, np.empty(0, np.uint64)))
                else:
                    held[i] = group, shingle_set(text, size)
            if len(found) > 10_000:
                yield flush()
        finish()
        yield flush()

    return rows.select("chunk", "id", "text", "visitor", "grp").repartition("chunk").sortWithinPartitions("chunk", "visitor").mapInArrow(released(run), "a long, b long")


def confirmed(docs: DataFrame, links: DataFrame, size: int, percent: int, id_col: str, text_col: str, classes: DataFrame | None = None) -> DataFrame:
    """(a, b): links that make the groups that links confirmed on full sets make: these links, or from a document to its group's least.

    Links are between doc_ids or, with ``classes`` (node, rep, fingerprint), between nodes:
    of a doc_id's texts the one with the class's fingerprint counts.
    """
    clusters = written(components(links), "clusters")
    sizes = clusters.groupBy("component").agg(F.count("*").alias("n"))
    members = clusters.join(sizes, "component").withColumn("chunks", F.ceil(F.col("n") / CHUNK))
    texts = texts_of(docs.filter(F.col(id_col).isNotNull()), id_col, text_col)
    # the same way of joining at every size: members grow with the documents
    if classes is None:
        texts = texts.join(members.hint("merge"), texts["doc_id"] == members["id"]).dropDuplicates(["id"])
    else:
        members = members.join(classes.select(F.col("node").alias("id"), "rep", "fingerprint"), "id")
        texts = _printed(texts.join(members.hint("merge"), texts["doc_id"] == members["rep"]), size)
        texts = texts.filter(F.col("print") == F.col("row.fingerprint")).select("row.*").dropDuplicates(["id"])
    own = F.pmod(F.xxhash64("id"), F.col("chunks"))
    stored = written(texts.select("id", "component", "chunks", own.alias("own"), "text"), "members")
    # the cluster's first documents, by degree in the candidate graph, go to each of its chunks
    as_rows = lambda df, chunk, visitor, grp: df.select(F.concat_ws(":", "component", chunk).alias("chunk"), "id", "text", F.lit(visitor).alias("visitor"), grp.alias("grp"))
    none = F.lit(0).cast("long")
    plain = as_rows(stored, "own", False, none)
    many = stored.filter("chunks > 1")
    if many.isEmpty():
        return _compare(plain, size, percent)
    degree = links.groupBy("a").agg(F.count("*").alias("degree")).withColumnRenamed("a", "id")
    copies = as_rows(_anchors(many, degree).join(stored.select("id", "text"), "id"), "copy", False, none)
    first = written(_compare(plain.unionByName(copies), size, percent), "links")
    # every document outside its large cluster's largest group visits the cluster's other chunks,
    # so each pair of groups that chunks kept apart is compared in full
    groups = components(first).select("id", F.col("component").alias("g"))
    marked = written(many.join(groups, "id", "left").withColumn("g", F.coalesce("g", "id")), "groups")
    sizes = marked.groupBy("component", "g").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("component").agg(F.max_by("g", F.struct("n", "g")).alias("largest"))
    outside = marked.join(largest, "component").filter("g <> largest")
    visits = outside.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1))).filter("copy <> own")
    hosts = marked.join(outside.select("component").distinct(), "component", "left_semi")
    met = _compare(as_rows(hosts, "own", False, F.col("g")).unionByName(as_rows(visits, "copy", True, F.col("g"))), size, percent)
    return groups.select(F.col("id").alias("a"), F.col("g").alias("b")).unionByName(met)


def _anchors(many: DataFrame, degree: DataFrame) -> DataFrame:
    """(id, component, copy): the documents of each large cluster with most candidate links, once for each chunk but their own."""
    top = F.max_by(F.struct("id", "own"), F.struct("degree", "id"))
    # the best of each of ANCHORS hash classes: an aggregation with partial results, no group in memory
    best = many.select("id", "component", "chunks", "own").join(degree, "id").groupBy("component", "chunks", F.pmod(F.xxhash64("id", F.lit("anchor")), F.lit(ANCHORS)).alias("slot")).agg(top.alias("x"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1))
    return best.select(F.col("x.id").alias("id"), "component", F.col("x.own").alias("own"), copies.alias("copy")).filter("copy <> own").drop("own")


def _groups(df: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Every row's (doc_id, n_shingles, fingerprint); each class's (fingerprint, rep, node, component, least);
    and the doc_ids that have texts of different sets, None if there are none.

    A class is a node of the link graph by its representative's doc_id. Where a doc_id has several
    texts it may represent several classes; nodes then are the numbers of the classes by doc_id.
    """
    rows = written(signatures(df, size, id_col, text_col), "signatures")
    prints = F.xxhash64(F.coalesce("fingerprint", F.lit(b"")))
    mixed = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min(prints).alias("lo"), F.max(prints).alias("hi")).filter("lo <> hi").select("doc_id")
    mixed = written(mixed, "mixed")
    unlike = not mixed.isEmpty()
    named = rows.filter("doc_id is not null and fingerprint is not null")
    classes = written(named.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    classes = row_ids(classes, ["rep", "fingerprint"], "node") if unlike else classes.withColumn("node", F.col("rep"))
    links = written(candidates(classes, percent / 100), "candidates")
    groups = components(confirmed(df, links, size, percent, id_col, text_col, classes if unlike else None))
    of = classes.select("fingerprint", "rep", "node").join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    if unlike:
        return rows, of.join(classes.select(F.col("node").alias("component"), F.col("rep").alias("least")), "component"), mixed
    return rows, of.withColumn("least", F.col("component")), None


def near_duplicates(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets.
    """
    rows, of, _ = _groups(df, size, percent, id_col, text_col)
    return _marked(rows, of)


def _marked(rows: DataFrame, of: DataFrame) -> DataFrame:
    rows = rows.select("doc_id", "n_shingles", "fingerprint")
    out = rows.filter("fingerprint is not null").join(of.select("fingerprint", F.col("least").alias("component")), "fingerprint", "left")
    # rows without shingles are in no class: in the join they would all go to one task
    out = out.unionByName(rows.filter("fingerprint is null").withColumn("component", F.lit(None).cast("long")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, of the least doc_id of each group; null ids keep all.

    Rows with the same doc_id and the same set of shingles keep one; a doc_id's texts of
    different sets are documents of their own.
    """
    rows, of, mixed = _groups(df, size, percent, id_col, text_col)
    gone = _marked(rows, of).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    named, key = df.filter(F.col(id_col).isNotNull()), F.col(id_col).cast("long")
    nulls = df.filter(F.col(id_col).isNull())
    if mixed is None:
        return named.join(gone, key == gone["_gone"], "left_anti").dropDuplicates([id_col]).unionByName(nulls)
    ids = mixed.select(F.col("doc_id").alias("_mixed"))
    plain = named.join(ids, key == ids["_mixed"], "left_anti").join(gone, key == gone["_gone"], "left_anti").dropDuplicates([id_col])
    # of a doc_id with several texts, the rows of its groups' least classes stay, and one without shingles
    several = _printed(named.join(ids, key == ids["_mixed"], "left_semi"), size, text_col).withColumn("_id", F.col("row").getField(id_col).cast("long"))
    least = of.filter("node = component").select("fingerprint", "rep")
    first = several.join(least, (F.col("print") == F.col("fingerprint")) & (F.col("_id") == F.col("rep")), "left_semi")
    kept = first.unionByName(several.filter("print is null")).dropDuplicates(["_id", "print"]).select("row.*")
    return plain.unionByName(kept).unionByName(nulls)
