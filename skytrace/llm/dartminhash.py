"""Near-duplicates by DartMinHash signatures and banding.

A document is the weighted set of its shingles (five words, weighted by count). Darts are thrown
by hashing: the board of one shingle is weight x rank, cut into unit weight cells and rank
cells (dyadic below 1, unit above), and each cell's number of darts, their ranks and
coordinates follow from a hash of (shingle, cell). A document keeps the darts that lie under its
weights, and per coordinate the one of least rank. Two documents agree at a coordinate with the
probability of their weighted Jaccard similarity. Only about k ln k + 2k darts have to be thrown
whatever the document's size: those of rank below (k ln k + 2k) / total weight; the bound is
doubled for the documents (about one in eight) that have a coordinate left empty.

Documents with equal words are merged first. BANDS bands of ROWS coordinates deal the others to
buckets. There, exact similarities are taken to a leading document or two first; only documents of
components still apart meet in pairs, and of those pairs the ones whose signatures agree nearly
enough are compared. A group of near copies costs a few comparisons a document, not all pairs; no
bucket is cut short. Classes are the connected components of the links.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**8)**64 = 8e-6.

Defined cases: words are split at ASCII white space, A-Z lower-cased. A text of one to four words is
one shingle. A text without words (null, empty) is like no other: its class is its own id. Rows with
one doc_id are one node, hence in one class. A row without id has a null class. Ties take the least
id. Texts of any length are sketched whole, one at a time beyond a piece's bytes. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import (LOWER, NOT_SPACE, col, id_text, int_col, mix64, nullable, packed, pieces, prefix, row_of,
                     span_hash, text_buffer, unpacked, whole_row, word_hashes, word_spans)
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 8, 64
#: Text bytes handled at once inside a task: some dozen numbers stand for each word meanwhile.
WORK_BYTES = 1 << 19
_C = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: Rank cells 0, 1, 2 are [0, 1/4), [1/4, 1/2), [1/2, 1); cell c from 3 on is [c-2, c-1).
_DYADIC = 3
_LOW = np.array([0.0, 0.25, 0.5])
_WIDTH = np.array([0.25, 0.25, 0.5, 1.0])
#: Poisson distribution functions of the cell widths.
_CDF = np.array([np.cumsum([np.exp(-w) * w ** j / float(np.prod(np.arange(1, j + 1))) for j in range(20)]) for w in _WIDTH])


# ---------------------------------------------------------------------- shingles
def shingles(arr, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(elements, offsets, k1, k2) of texts: one element per occurrence of a shingle, so that counts
    are weights, ascending within a text; k1 and k2 hash the whole word sequence."""
    data, offs = text_buffer(arr)
    data = LOWER[data]
    starts, ends, at = word_spans(data, offs, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    n = np.diff(at)
    h = prefix(words)
    k1 = span_hash(h, at[:-1], at[1:])
    k2 = span_hash(prefix(mix64(words ^ _C[0])), at[:-1], at[1:])
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    sh_at = np.append(0, np.cumsum(count))
    row = row_of(sh_at)
    first = np.arange(sh_at[-1]) - sh_at[row] + at[row]
    hashes = span_hash(h, first, first + np.minimum(size, n[row]))
    # number the occurrences of one shingle in one text
    key = mix64(hashes + row.astype(np.uint64) * _C[1])
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    run = np.flatnonzero(fresh)
    nth = np.empty(len(key), np.int64)
    nth[order] = np.arange(len(key)) - np.repeat(run, np.diff(np.append(run, len(key))))
    return mix64(hashes + nth.astype(np.uint64) * _C[2]), sh_at, k1, k2


# -------------------------------------------------------------------------- darts
def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _throw(elements: np.ndarray, at: np.ndarray, part: np.ndarray | None, theta: np.ndarray, k: int):
    """Least-rank dart of every coordinate: (documents x k dart ids, documents x k ranks)."""
    docs = len(at) - 1
    row = row_of(at)
    top = theta[row]
    cells = np.searchsorted(_LOW, np.minimum(top, 1.0)) + np.maximum(np.ceil(top) - 1, 0).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), cells)
    cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    board = mix64(elements[owner] + cell.astype(np.uint64) * _C[3])
    kind = np.minimum(cell, _DYADIC)
    u = _uniform(board)
    best, ident = np.full(docs * k, np.inf), np.zeros(docs * k, np.uint64)
    live, j = np.flatnonzero(u >= _CDF[kind, 0]), 0
    slots, ranks, ids = [], [], []
    while len(live):  # the j-th dart of the cells that have one
        dart = mix64(board[live] + np.uint64((j + 1) * int(_C[0]) & 0xFFFFFFFFFFFFFFFF))
        c = cell[live]
        low = np.where(c < _DYADIC, _LOW[np.minimum(c, _DYADIC - 1)], c - (_DYADIC - 1.0))
        rank = low + _WIDTH[kind[live]] * _uniform(mix64(dart + _C[1]))
        o = owner[live]
        on = rank < top[o]
        if part is not None:  # the weight cell of this element is only partly under the weight
            on &= _uniform(mix64(dart + _C[2])) < part[o]
        slots.append(row[o[on]] * k + (mix64(dart[on] ^ _C[3]) % np.uint64(k)).astype(np.int64))
        ranks.append(rank[on])
        ids.append(dart[on])
        j += 1
        live = live[u[live] >= _CDF[kind[live], j]] if j < _CDF.shape[1] else live[:0]
    if slots:
        slot, rank, dart = map(np.concatenate, (slots, ranks, ids))
        np.minimum.at(best, slot, rank)
        won = rank == best[slot]
        ident[slot[won]] = dart[won]
    return ident.reshape(docs, k), best.reshape(docs, k)


def sketch(elements: np.ndarray, at: np.ndarray, k: int, part: np.ndarray | None = None,
           work: int = 50_000) -> np.ndarray:
    """Signatures (documents x k) of ragged unit-weight elements; ``part`` (0 to 1] gives an element
    less weight than 1. A document without elements has the signature 0."""
    out = np.zeros((len(at) - 1, k), np.uint64)
    weight = np.diff(at).astype(float) if part is None else np.add.reduceat(
        np.append(part, 0.0), at[:-1]) * (np.diff(at) > 0)
    todo = np.flatnonzero(weight > 0)
    theta = np.zeros(len(weight))
    theta[todo] = (k * np.log(k) + 2 * k) / weight[todo]
    while len(todo):
        again = []
        cost = np.cumsum(np.diff(at)[todo] * (_DYADIC + np.ceil(theta[todo])))
        groups = np.split(todo, np.flatnonzero(np.diff(cost // work)) + 1)
        for g in groups:
            sizes = np.diff(at)[g]
            own = np.append(0, np.cumsum(sizes))
            take = np.arange(own[-1]) + np.repeat(at[g] - own[:-1], sizes)
            ident, rank = _throw(elements[take], own, None if part is None else part[take], theta[g], k)
            full = np.isfinite(rank).all(1)
            out[g[full]] = ident[full]
            again.append(g[~full])
        todo = np.concatenate(again)
        theta[todo] *= 2
    return out


def _sketches(size: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, max_bytes=WORK_BYTES):
            elements, at, k1, k2 = shingles(col(b, "_text"), size)
            n = np.diff(at)
            # equal texts of a batch are sketched once
            _, first = np.unique(k1, return_index=True)
            some = np.sort(first[n[first] > 0])
            own = np.append(0, np.cumsum(n[some]))
            take = np.arange(own[-1]) + np.repeat(at[some] - own[:-1], n[some])
            ident = sketch(elements[take], own, rows * bands).reshape(len(some), bands, rows)
            place = np.arange(rows, dtype=np.uint64) * _C[1]
            keys = mix64(mix64(ident + place).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _C[2])
            lists = np.zeros(b.num_rows, np.int64)
            lists[some] = bands
            ids, null = int_col(b, "_id")
            yield pa.RecordBatch.from_arrays([
                nullable(ids, null, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(n),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lists)), pa.int32()),
                                         pa.array(keys.view(np.int64).ravel())),
            ], names=["_id", "_k1", "_k2", "_n", "_bands"])

    return run


# ------------------------------------------------------------------- verification
def _compare(size: int, threshold: float):
    """Rows sorted so that a leader's text comes before those held against it -> linked pairs. (A leader
    has several texts where rows share its id.)"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own, seen = None, [], set()
        for b, texts in unpacked(batches, WORK_BYTES):
            names, salts, roles, ids = (col(b, x).to_pylist() for x in ("_leader", "_salt", "_role", "_id"))
            sets, at, k1, _ = shingles(pa.array(texts, pa.large_binary()), size)
            found = []
            for i, (name, salt, role, other) in enumerate(zip(names, salts, roles, ids, strict=True)):
                mine = sets[at[i]:at[i + 1]]
                if (name, salt) != group:
                    group, own, seen = (name, salt), [], set()
                if role == 0:
                    if int(k1[i]) not in seen:
                        seen.add(int(k1[i]))
                        own.append(np.sort(mine))
                    continue
                for lead in own:
                    common = _common(lead, mine)
                    if common >= threshold * (len(lead) + len(mine) - common):
                        found.append((name, other))
                        break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)],
                                                 names=["a", "b"])

    return run


def _common(ordered: np.ndarray, other: np.ndarray) -> int:
    """How many elements of ``other`` are in the sorted array; both hold distinct elements."""
    if not len(ordered):
        return 0
    at = np.minimum(np.searchsorted(ordered, other), len(ordered) - 1)
    return int((ordered[at] == other).sum())


#: Members held against one copy of a leader's text.
SALT_ROWS = 512


def verify(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of distinct ids whose exact weighted Jaccard similarity reaches the threshold.

    A leader's text is sent once per SALT_ROWS members, to as many groups, so that a hot leader is
    no single task's burden; member texts are sent once per pair.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("_salts"))
    salted = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("_salts")).cast("int").alias("_salt"))
    sent = (salted.select(F.col("b").alias("_id"), F.col("a").alias("_leader"), "_salt", F.lit(1).alias("_role"))
            .unionByName(salted.select(F.col("a").alias("_id"), F.col("a").alias("_leader"), "_salt",
                                       F.lit(0).alias("_role")).distinct()))
    return (sent.join(texts, "_id").repartition("_leader", "_salt")
            .sortWithinPartitions("_leader", "_salt", "_role", "_id")
            .mapInArrow(_compare(size, threshold), "a long, b long").distinct())


def _lead_pairs(waiting: DataFrame, lead: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of each bucket's leader and its waiting rows of other components."""
    pairs = (waiting.join(lead, "_bucket").filter("_root != _lroot")
             # a similarity of at least the threshold needs weights that close
             .filter(F.least("_n", "_ln") >= threshold * F.greatest("_n", "_ln")))
    return pairs.select(F.least("_lead", "_rep").alias("a"), F.greatest("_lead", "_rep").alias("b")).distinct()


def _open(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold rows of several components."""
    split = rows.groupBy("_bucket").agg(F.min("_root").alias("_x"), F.max("_root").alias("_y")).filter("_x < _y")
    return rows.join(split.select("_bucket"), "_bucket")


def _grown(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (_rep, _root) of the links and of those that gave ``roots``, which stand for them as stars."""
    if roots is not None:
        links = links.unionByName(roots.filter("_rep != _root").select(F.col("_root").alias("a"), F.col("_rep").alias("b")))
    return components(links).toDF("_rep", "_root")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.drop("_root").join(roots, "_rep", "left").withColumn("_root", F.coalesce("_root", "_rep"))


#: Coordinates, of which two bits are kept, for estimates of similarity, and the standard errors below
#: the threshold at which an estimate still makes a candidate.
ESTIMATE, MARGIN = 2048, 4.5
#: Rows of a bucket that one block holds.
BLOCK_ROWS = 1024


def _signed(size: int):
    """Packed texts -> signatures of two bits per coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in unpacked(batches, WORK_BYTES):
            elements, at, _, _ = shingles(pa.array(texts, pa.large_binary()), size)
            bits = (sketch(elements, at, ESTIMATE) >> np.uint64(17)).astype(np.uint8) & 3
            sig = (bits.reshape(-1, ESTIMATE // 4, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(2, dtype=np.uint8)
            yield pa.RecordBatch.from_arrays([col(b, "_id"), pa.array([x.tobytes() for x in sig], pa.binary())],
                                             names=["_rep", "_sig"])

    return run


def _likely(threshold: float):
    """Blocks sorted with their leading rows first -> pairs whose signatures agree often enough."""
    agree = threshold + (1 - threshold) / 4  # other coordinates agree in two bits by chance
    most = ESTIMATE * (1 - agree + MARGIN * (agree * (1 - agree) / ESTIMATE) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lead = None, []
        for b in batches:
            found = []
            for key, salt, role, rep, n, root, sig in zip(*(col(b, x).to_pylist() for x in (
                    "_bucket", "_block", "_role", "_rep", "_n", "_root", "_sig")), strict=True):
                if (key, salt) != block:
                    block, lead, table = (key, salt), [], None
                if role == 0:
                    lead.append((rep, n, root, np.frombuffer(sig, np.uint64)))
                    continue
                if table is None:
                    reps, ns, roots = (np.array(x) for x in list(zip(*lead, strict=True))[:3])
                    table = np.stack([x[3] for x in lead])
                on = np.flatnonzero((roots != root) & (np.minimum(ns, n) >= threshold * np.maximum(ns, n)))
                differ = table[on] ^ np.frombuffer(sig, np.uint64)
                differ = np.bitwise_count((differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(1)
                found += [(min(rep, x), max(rep, x)) for x in reps[on[differ <= most]].tolist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*set(found), strict=True)],
                                                 names=["a", "b"])

    return run


def _rest_pairs(rows: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Likely pairs of rows of different components in one bucket: every row outside a bucket's largest
    component is sent to all of the bucket's blocks."""
    rows = materialise(rows, "open-rows")
    signed = texts.join(rows.select(F.col("_rep").alias("_id")).distinct(), "_id", "left_semi")
    signed = signed.mapInArrow(_signed(size), "_rep long, _sig binary")
    parts = rows.groupBy("_bucket", "_root").agg(F.count("*").alias("_c"))
    main = parts.groupBy("_bucket").agg(F.max_by("_root", F.struct("_c", "_root")).alias("_main"), F.sum("_c").alias("_all"))
    all_ = rows.join(main, "_bucket").withColumn("_blocks", F.ceil(F.col("_all") / BLOCK_ROWS).cast("int")).join(signed, "_rep")
    member = all_.withColumn("_block", F.pmod(F.xxhash64("_rep"), F.col("_blocks")).cast("int")).withColumn("_role", F.lit(1))
    lead = (all_.filter("_root != _main").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("_role", F.lit(0)))
    names = ["_bucket", "_block", "_role", "_rep", "_n", "_root", "_sig"]
    return (member.select(names).unionByName(lead.select(names)).repartition("_bucket", "_block")
            .sortWithinPartitions("_bucket", "_block", "_role", "_rep")
            .mapInArrow(_likely(threshold), "a long, b long").distinct())


def bucket_classes(members: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Rows (_bucket, _rep, _n) -> the components (_rep, _root) of all links within buckets; a row without a link is left out.

    1. In every bucket the least id leads: all others are compared with it.
    2. In buckets of several components the row with most links so far leads (a text that many
       others were made from joins its copies here).
    3. In the buckets left over, the rows outside the largest component meet all rows of other
       components; of these pairs the likely ones are compared.
    So each pair of a bucket is compared, in one component already, or estimated at MARGIN standard
    errors below the threshold, which a pair at the threshold is with probability 3e-6.
    """
    if members.isEmpty():
        return members.sparkSession.createDataFrame([], "_rep long, _root long")
    rows = members.withColumn("_root", F.col("_rep"))
    lead = rows.groupBy("_bucket").agg(F.min_by(F.struct("_rep", "_n", "_root"), "_rep").alias("x"))
    lead = lead.select("_bucket", F.col("x._rep").alias("_lead"), F.col("x._n").alias("_ln"), F.col("x._root").alias("_lroot"))
    pairs = materialise(_lead_pairs(rows, lead, threshold), "pairs")
    links = materialise(verify(pairs, texts, size, threshold), "links")
    roots = _grown(None, links)
    rows = materialise(_open(_rooted(rows, roots)), "waiting")
    if rows.isEmpty():
        return roots
    degree = (links.select(F.col("a").alias("_rep")).unionByName(links.select(F.col("b").alias("_rep")))
              .groupBy("_rep").agg(F.count("*").alias("_degree")))
    rank = F.struct(F.coalesce("_degree", F.lit(0)).alias("d"), (-F.col("_rep")).alias("r"))
    lead = (rows.join(degree, "_rep", "left").groupBy("_bucket")
            .agg(F.max_by(F.struct("_rep", "_n", "_root"), rank).alias("x")))
    lead = lead.select("_bucket", F.col("x._rep").alias("_lead"), F.col("x._n").alias("_ln"), F.col("x._root").alias("_lroot"))
    more = materialise(_lead_pairs(rows, lead, threshold).join(pairs, ["a", "b"], "left_anti"), "pairs")
    pairs = pairs.unionByName(more)
    roots = _grown(roots, materialise(verify(more, texts, size, threshold), "links"))
    rows = materialise(_open(_rooted(rows, roots)), "waiting")
    if rows.isEmpty():
        return roots
    rest = _rest_pairs(rows, texts, size, threshold).join(pairs, ["a", "b"], "left_anti")
    return _grown(roots, materialise(verify(materialise(rest, "pairs"), texts, size, threshold), "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per document: its id and ``class_id``, the least id of its class."""
    docs = id_text(docs, id_col, text_col)
    # rows without id go first: a batch sketches only the first of equal texts, which must be kept
    seen = materialise(docs.filter("_id is not null").mapInArrow(_sketches(size, rows, bands),
                       "_id long, _k1 long, _k2 long, _n long, _bands array<long>"), "sketches")
    usable = seen.filter("_n > 0")
    # equal word sequences: one representative each
    same = materialise(usable.groupBy("_k1", "_k2").agg(
        F.min("_id").alias("_rep"), F.max("_n").alias("_n"),
        F.max(F.when(F.size("_bands") > 0, F.col("_bands"))).alias("_bands")), "distinct-texts")
    dealt = same.select("_rep", "_n", F.explode("_bands").alias("_bucket"))
    shared = dealt.groupBy("_bucket").agg(F.count("*").alias("_c")).filter("_c > 1").select("_bucket")
    members = materialise(dealt.join(shared, "_bucket"), "buckets")
    texts = materialise(packed(docs, "_id").join(members.select(F.col("_rep").alias("_id")).distinct(), "_id", "left_semi"),
                        "texts")
    roots = bucket_classes(members, texts, size, threshold)
    own = usable.join(same.select("_k1", "_k2", "_rep"), ["_k1", "_k2"]).select("_id", "_rep")
    least = materialise(own.groupBy("_id").agg(F.min("_rep").alias("_rep"), F.max("_rep").alias("_last")), "own")
    several = least.filter("_rep < _last").select("_id")  # rows of one id with different texts
    if not several.isEmpty():
        roots = _grown(roots, own.join(several, "_id").select(F.col("_rep").alias("a"), F.col("_id").alias("b")))
    classes = _rooted(least.select("_id", "_rep"), roots).select(F.col("_id").alias("node"), "_root")
    return (docs.select("_id").join(classes, F.col("_id") == F.col("node"), "left")
            .select(F.col("_id").alias(id_col), F.coalesce("_root", "_id").alias("class_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents less all but the one of least id of each class; rows without id stay."""
    classes = near_duplicates(docs, id_col, text_col, **options).toDF("_id", "_class")
    kept = classes.filter("_id = _class").select("_id").distinct()
    rows = docs.select(docs[id_col].cast("long").alias("_id"), whole_row(docs))
    first = rows.join(kept, "_id").dropDuplicates(["_id"]).unionByName(rows.filter("_id is null"))
    return first.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
