"""N-gram Jaccard join by MinHash banding.

Two documents are linked when the Jaccard similarity of their sets of
five-word shingles is 0.8 or more. Words are runs of characters other than
ASCII white space, lower-cased; a text of one to four words has one shingle,
all its words; a null text or one without words has none and no links.

1. Shingles are hashed to 64 bits and minhashed. Bands and rows follow from the
   recall wanted at the threshold (`choose_bands`).
2. Documents with the same set of shingles are copies: one node stands for
   them, with their number, and they are not paired with each other.
3. Nodes are shuffled on band hashes. Each bucket points its nodes at its least
   one, which is as many rows as the bucket has, whatever its size, and the
   components of these pointers are the candidate groups.
4. Candidate groups are verified on full shingle sets: all pairs of a group are
   counted by matrix products over shared shingles, tile by tile. A group of up to
   `BLOCK` shingles (ten thousand documents of 300 words) is one task, and each of
   its sets moves once; a larger one is dealt to blocks of that size and every pair
   of blocks is a task, so a set moves as often as the group has blocks. Tasks give
   each node's number of links and its local root, never pairs.
5. Roots of block pairs are joined into classes.

Rows without an id take no part: class null, no links. Rows that share an id
are told apart by their shingles. Empty tables give empty results; other
columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import column, cut, map_arrow, maybe_broadcast, ship, table, trim, unused
from .components import components

WORDS = 5
#: The threshold as a fraction, so that equality is exact.
OVER, UNDER = 4, 5
TARGET_RECALL, MAX_HASHES = 0.9999, 192
SEED = 20_231
#: Shingles of a group to a task, 24 MB of them: a larger group is dealt to blocks of that size. And of the small groups together.
BLOCK, BIN = 3_000_000, 1_500_000
#: Nodes and shared shingles to a matrix product.
TILE, COLUMNS = 1024, 4096

_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def choose_bands(threshold: float = OVER / UNDER, recall: float = TARGET_RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands still reach `recall` at the threshold within `most` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = ceil(log(1 - recall) / log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


BANDS, ROWS = choose_bands()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = (_RANDOM.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_B = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)[:, None]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = _SPLIT.findall((text or "").lower())
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(h))):
        out += _mix(h[k : k + n] * _FACTORS[k] + np.uint64(k + 1))
    return np.unique(_mix(out))


def set_key(found: np.ndarray) -> bytes:
    return hashlib.md5(found.tobytes()).digest()


def band_hashes(found: np.ndarray, chunk: int = 2048) -> np.ndarray:
    """One signed 64-bit hash for each band."""
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(found), chunk):
        np.minimum(least, (found[i : i + chunk] * _A + _B).min(axis=1), out=least)
    folded = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        folded = _mix(folded * np.uint64(31) + least.reshape(BANDS, ROWS)[:, k])
    return folded.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rid, doc_id, key, size, bands of each row with an id; key is null without words, bands empty where a set of one shingle has no other neighbours than copies."""
    kind = dict(docs.dtypes)[id_col]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, sizes, bands = [], [], []
        for text in b.column(1).to_pylist():
            found = shingles(text)
            keys.append(set_key(found) if len(found) else None)
            sizes.append(len(found))
            bands.append(band_hashes(found) if len(found) > 1 else [])
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "key", "size", "bands"])

    rows = docs.where(column(id_col).isNotNull()).select(column(id_col), column(text_col))
    return map_arrow(rows, batch, f"doc_id {kind}, key binary, size bigint, bands array<bigint>").withColumn("rid", F.monotonically_increasing_id())


def _verify_group(rows: pa.Table) -> pa.Table:
    """Links and local roots within one task's nodes. side 2: both blocks, of which only cross pairs count."""
    out: list[tuple[int, int, int, int]] = []
    group, side = rows["grp"].to_numpy(), rows["side"].to_numpy()
    node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
    sets = rows["shingles"].combine_chunks()
    starts, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, cuts):
        out += _links(node[part], copies[part], side[part], [flat[starts[i] : starts[i + 1]] for i in part])
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table(dict(zip(("node", "root", "texts", "docs"), (pa.array(c, pa.int64()) for c in columns), strict=True)))


class Shared:
    """Sets over codes of the shingles that more than one of them has, for counting what pairs share."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        owner, flat = np.repeat(np.arange(len(sets)), self.sizes), np.concatenate(sets)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        self.total = int(shared.sum())
        place = np.cumsum(shared) - 1
        keep = shared[code]
        self.code, owner = place[code[keep]], owner[keep]
        self.ends = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.owner = owner

    def dense(self, first: int, last: int, at: int) -> np.ndarray:
        """Sets first to last as rows over `COLUMNS` codes from `at` on."""
        i, j = self.ends[first], self.ends[last]
        code, row = self.code[i:j] - at, self.owner[i:j] - first
        mine = (code >= 0) & (code < COLUMNS)
        out = np.zeros((last - first, min(COLUMNS, self.total - at)), dtype=np.float32)
        out[row[mine], code[mine]] = 1
        return out

    def similar(self, a: tuple[int, int], b: tuple[int, int]) -> np.ndarray:
        """Boolean matrix of the pairs of two ranges of sets at or over the threshold."""
        both = np.zeros((a[1] - a[0], b[1] - b[0]), dtype=np.float64)
        for at in range(0, self.total, COLUMNS):
            x = self.dense(*a, at)
            both += x @ (x if a == b else self.dense(*b, at)).T
        both = np.rint(both).astype(np.int64)
        union = self.sizes[a[0] : a[1], None] + self.sizes[None, b[0] : b[1]] - both
        return both * UNDER >= OVER * union


class _Joined:
    """Least root of joined numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _least(link: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least number that each row and column of a link matrix reaches."""
    none = np.iinfo(np.int64).max
    while True:
        new_rows = np.minimum(rows, np.where(link, columns[None, :], none).min(1))
        new_columns = np.minimum(columns, np.where(link, new_rows[:, None], none).min(0))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def _links(node: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    order = np.argsort(node, kind="stable")
    node, copies, side, sets = node[order], copies[order], side[order], [sets[i] for i in order]
    n, split = len(node), side.any()
    shared, joined = Shared(sets), _Joined(n)
    texts, docs = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    ranges = [(i, min(n, i + TILE)) for i in range(0, n, TILE)]
    for p, a in enumerate(ranges):
        for b in ranges[p:]:
            link = shared.similar(a, b)
            if a == b:
                np.fill_diagonal(link, False)
            if split:
                link &= side[a[0] : a[1], None] != side[None, b[0] : b[1]]
            if not link.any():
                continue
            texts[a[0] : a[1]] += link.sum(1)
            docs[a[0] : a[1]] += link @ copies[b[0] : b[1]]
            if a != b:
                texts[b[0] : b[1]] += link.sum(0)
                docs[b[0] : b[1]] += copies[a[0] : a[1]] @ link
            for first, least in zip((a[0], b[0]), _least(link, np.arange(*a), np.arange(*b)), strict=True):
                for i, k in enumerate(least.tolist()):
                    joined.join(first + i, k)
    return [(int(node[i]), int(node[joined.root(i)]), int(texts[i]), int(docs[i])) for i in np.flatnonzero(texts).tolist()]


def _verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(node, root, texts, docs) of the linked nodes, and whether roots of several blocks are to be joined."""
    grouped = groups.join(nodes.select("node", F.col("doc_id").alias("__id"), "key", "copies", "size"), "node")
    sizes = cut(grouped.groupBy("root").agg(F.sum("size").alias("weight")))
    stats = sizes.agg(F.count("*").alias("n"), F.sum("weight").alias("total"), F.max("weight").alias("most")).first()
    weight, most = stats["total"] or 0, stats["most"] or 0
    blocks = F.ceil(F.col("weight") / BLOCK).cast("int")
    wanted = cut(grouped.join(maybe_broadcast(sizes, stats["n"]), "root").select("node", "root", "__id", "key", "copies", blocks.alias("blocks")))
    total = wanted.count()
    texts = docs.select(column(id_col).alias("__id"), column(text_col).alias("text"))
    texts = texts.join(maybe_broadcast(wanted, total), "__id").select("text", "key", "node", "root", "copies", "blocks")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t) for t in b.column("text").to_pylist()]
        same = [set_key(f) == k for f, k in zip(found, b.column("key").to_pylist(), strict=True)]
        values = pa.array([f.view(np.int64) if s else None for f, s in zip(found, same, strict=True)], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*[b.column(c) for c in ("node", "root", "copies", "blocks")], values], ["node", "root", "copies", "blocks", "shingles"])

    sets = map_arrow(texts, batch, "node bigint, root bigint, copies bigint, blocks int, shingles array<bigint>").where("shingles IS NOT NULL")
    sets = sets.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    bins = max(1, weight // BIN)
    whole = sets.where("blocks = 1").select(F.pmod(F.xxhash64("root"), F.lit(bins)).alias("task"), F.col("root").alias("grp"), F.lit(0).alias("side"), "node", "copies", "shingles")
    if most > BLOCK:
        split = sets.where("blocks > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        low, high = F.least("mine", "other"), F.greatest("mine", "other")
        split = split.select(F.xxhash64("root", low, high).alias("task"), F.xxhash64("root", low, high).alias("grp"), F.when(low == high, 0).when(F.col("mine") == low, 1).otherwise(2).alias("side"), "node", "copies", "shingles")
        whole = whole.unionByName(split)
    ship(docs.sparkSession)
    once = whole.groupBy("task").applyInArrow(_dedupe_then_verify, "node bigint, root bigint, texts bigint, docs bigint")
    return cut(once), most > BLOCK


def _dedupe_then_verify(rows: pa.Table) -> pa.Table:
    """Rows that were there twice (same id and text) count once."""
    key = rows["grp"].to_numpy().astype(np.int64), rows["node"].to_numpy()
    _, first = np.unique(np.stack(key), axis=1, return_index=True)
    try:
        return _verify_group(rows if len(first) == rows.num_rows else rows.take(pa.array(np.sort(first))))
    finally:
        trim()


def _linked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of `link_documents` and rid, key and class of each row with an id; class is the same for what links connect."""
    sig = cut(signatures(docs, id_col, text_col))
    twins = cut(sig.where("key IS NOT NULL").groupBy("key").agg(F.min("rid").alias("node"), F.count("*").alias("copies"), F.min("doc_id").alias("copy_id")).where("copies > 1"))
    twins_hint = maybe_broadcast(twins, twins.count())
    own = lambda c, other: F.coalesce(F.col(c), other).alias(c)
    known = sig.join(twins_hint, "key", "left").select("rid", "doc_id", "key", "size", "bands", own("node", F.col("rid")), own("copies", F.lit(1).cast("bigint")), own("copy_id", F.col("doc_id")))
    members = cut(known.select("rid", "doc_id", "key", "size", "node", "copies", "copy_id"))
    nodes = members.where("rid = node AND key IS NOT NULL")
    buckets = known.where("rid = node").select("node", F.explode("bands").alias("bucket"))
    hubs = cut(buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("bucket", "hub"))
    edges = buckets.join(maybe_broadcast(hubs, hubs.count()), "bucket").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = cut(components(edges))
    linked, several = _verified(docs, nodes, groups, id_col, text_col)
    counts = linked.groupBy("node").agg(F.min("root").alias("root"), F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    if several:
        joined = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
        counts = counts.drop("root").join(joined, "node")
    counts = cut(counts.join(nodes.select("node", "copy_id"), "node"))
    classes = counts.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    of_node = cut(counts.join(classes, "root").select("node", "root", "class_id", "texts", "docs"))
    rows = members.join(maybe_broadcast(of_node, of_node.count()), "node", "left")
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "rid",
        "key",
        F.coalesce("root", "node").alias("class"),
        "doc_id",
        "copy_id",
        F.coalesce("class_id", "copy_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("docs", zero)).alias("n_links"),
        F.coalesce("texts", zero).alias("n_text_links"),
    )


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`.

    doc_id; copy_id, the least id with the same shingles; class_id, the least id
    of all that links connect; n_links, how many other rows are linked to it,
    copies included; n_text_links, how many different sets of shingles are.
    """
    out = _linked(docs, id_col, text_col).drop("rid", "key", "class")
    none, zero = F.lit(None).cast(dict(docs.dtypes)[id_col]), F.lit(0).cast("bigint")
    nameless = docs.where(column(id_col).isNull()).select(none.alias("doc_id"), none.alias("copy_id"), none.alias("class_id"), zero.alias("n_links"), zero.alias("n_text_links"))
    return out.unionByName(nameless)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of `docs`, of those with its least id, and the rows without an id.

    Where every id is there once, an anti-join on the id drops the others; rows
    that share an id are told apart by their shingles as well.
    """
    rows = cut(_linked(docs, id_col, text_col).select("rid", "doc_id", "key", "class"))
    best = cut(rows.groupBy("class").agg(F.min(F.struct("doc_id", "rid")).alias("best"), F.count("*").alias("n")).where("n > 1").select("class", F.col("best.rid").alias("stays")))
    gone_id, vague_id, key, stay_id, stay_key = unused(docs, "gone_id", "vague_id", "set_key", "stay_id", "stay_key")
    gone = cut(rows.join(maybe_broadcast(best, best.count()), "class").where("rid <> stays").select("rid", F.col("doc_id").alias(gone_id)))
    vague = cut(rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(vague_id)))
    n_gone, n_vague = gone.count(), vague.count()
    names, own = [column(c) for c in docs.columns], column(id_col)
    ids = maybe_broadcast(gone.select(gone_id), n_gone)
    if not n_vague:
        return docs.join(ids, own == F.col(gone_id), "left_anti").select(*names)
    shared = maybe_broadcast(vague, n_vague)
    plain = docs.join(shared, own == F.col(vague_id), "left_anti").join(ids, own == F.col(gone_id), "left_anti").select(*names)
    again = docs.join(shared, own == F.col(vague_id), "left_semi")
    at = docs.columns.index(text_col)

    def keyed(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t) for t in b.column(at).to_pylist()]
        keys = pa.array([set_key(f) if len(f) else None for f in found], pa.binary())
        return pa.RecordBatch.from_arrays([*b.columns, keys], [*b.schema.names, "key"])

    # Arrow operators take columns by name and some names not, so they go under numbers meanwhile
    numbered = [StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(again.schema.fields)]
    plainly = again.toDF(*[f.name for f in numbered])
    again = map_arrow(plainly, keyed, StructType([*numbered, StructField("key", BinaryType())])).toDF(*docs.columns, key)
    stay = rows.where("key IS NOT NULL").join(shared, F.col("doc_id") == F.col(vague_id), "left_semi").join(gone.select("rid"), "rid", "left_anti")
    stay = cut(stay.select(F.col("doc_id").alias(stay_id), F.col("key").alias(stay_key)))
    one = again.join(maybe_broadcast(stay, stay.count()), (own == F.col(stay_id)) & (F.col(key) == F.col(stay_key)), "left_semi").dropDuplicates([id_col, key])
    return plain.unionByName(again.where(F.col(key).isNull()).unionByName(one).select(*names))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b, k = na.c AND k = nb.c AS same
      FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * k >= 4 * (na.c + nb.c - k)),
    reach(node, other) AS (SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
    class AS (SELECT node, min(other) AS least FROM reach GROUP BY node),
    copy AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(b), d.doc_id)) AS copy_id FROM documents d LEFT JOIN links ON a = d.doc_id AND same GROUP BY d.doc_id),
    counted AS (SELECT a, count(*) AS n_links, count(DISTINCT CASE WHEN NOT same THEN c.copy_id END) AS n_text_links FROM links JOIN copy c ON c.doc_id = b GROUP BY a)
    SELECT c.doc_id, c.copy_id, least(c.copy_id, coalesce(class.least, c.copy_id)) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links
    FROM copy c LEFT JOIN class ON class.node = c.doc_id LEFT JOIN counted ON counted.a = c.doc_id"""

QUERIES = {"op3_ngram_jaccard_join": op3_ngram_jaccard_join}
ORACLES = {"op3_ngram_jaccard_join": ORACLE}
