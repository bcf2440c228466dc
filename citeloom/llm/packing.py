"""Best-fit packing with exact-complement hashing.

Documents become token ids with an end id; only those longer than a sequence
are cut, into full pieces and a rest. What is to be packed is then known from
the number of pieces of each length, a table of at most `CAPACITY` rows
whatever the corpus holds. On it the driver plans: for each length, longest
first, the gap that it leaves is looked up in indexes of the sums that single
lengths, pairs and triples of available lengths make, and combinations that
fill it exactly are consumed as often as availability counts allow. What finds
no complement is packed best-fit, longest first. A plan line is a pattern of
lengths and the number of sequences that follow it, so the plan is as small as
the table.

Pieces are numbered within their length (in salted groups, whose offsets are
running sums, so no task holds all pieces of a length) and find their sequence
and offset by that number in the plan. Full pieces are sequences of their own.

A null or empty text is the end id alone. Rows with equal or null ids are
packed as documents of their own. Empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from math import isqrt

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import cut, map_arrow, maybe_broadcast, table

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Segments kept from batch to batch in a worker; when more have come, the store starts anew.
CACHE_SEGMENTS = 700_000
#: Pieces to a numbered group at least; a length with many pieces is dealt to as many groups as each then holds.
GROUP_PIECES = 100

#: Segments whose normal form is plain lower-casing: ASCII and Latin letters, no combining marks, no unusual white space.
_PLAIN = re.compile(r"[\n\t!-~\xa1-įı-ɏ]*")


class WordTokenizer:
    """Ids as the tokenizers library gives them, computed once for each distinct segment between spaces.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its segments in order.
    """

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
            ],
        }
        self.words = Tokenizer.from_str(json.dumps(spec))
        self.words.encode_special_tokens = True
        self.segments: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn_pieces(self, pieces: list[str], portion: int = 200) -> None:
        for i in range(0, len(pieces), portion):
            part = pieces[i : i + portion]
            e = self.words.encode(" ".join(part), add_special_tokens=False)
            ids, word = np.array(e.ids, dtype="<u4"), np.array(e.word_ids)
            ends = 4 * np.searchsorted(word, np.arange(len(part) + 1))
            raw = ids.tobytes()
            for k, p in enumerate(part):
                self.pieces[p] = raw[ends[k] : ends[k + 1]]

    def _cut(self, segment: str) -> list[str]:
        """Pieces of a plain segment. The pattern keeps runs of letters whole, which need not be searched."""
        if segment.isalpha():
            return [segment if segment.islower() else segment.lower()]
        if segment[-1:] in (".", ",") and segment[:-1].isalpha():
            return [segment[:-1].lower(), segment[-1]]
        return self.pattern.findall(segment.lower())

    def _learn(self, new: list[str]) -> None:
        plain, odd = [], []
        for s in new:
            (plain if _PLAIN.fullmatch(s) else odd).append(s)
        found = [self._cut(s) for s in plain]
        self._learn_pieces(list(set().union(*found).difference(self.pieces)))
        known = self.pieces
        for s, c in zip(plain, found, strict=True):
            self.segments[s] = known[c[0]] if len(c) == 1 else b"".join([known[p] for p in c])
        for s, e in zip(odd, self.full.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            self.segments[s] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.segments) > CACHE_SEGMENTS:
            self.segments, self.pieces = {}, {}
        cut = [(t or "").split(" ") for t in texts]
        new = set().union(*cut).difference(self.segments)
        if new:
            self._learn(list(new))
        get = self.segments.__getitem__
        return [b"".join(map(get, c)) for c in cut]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of each piece."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = dict(docs.dtypes)[id_col]
    end = np.array([END_ID], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        source, rows, ids = [], [], []
        for i, raw in enumerate(tokenizer(path).encode(b.column(1).to_pylist())):
            raw += end
            n = len(raw) // 4
            for k, at in enumerate(range(0, n, capacity)):
                part = raw[4 * at : 4 * min(n, at + capacity)]
                source.append(i)
                rows.append((k, at, len(part) // 4, zlib.crc32(part)))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        out = [b.column(0).take(pa.array(source, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]]
        return pa.RecordBatch.from_arrays([*out, *[pa.array(ids, pa.list_(pa.int32()))] * with_ids], names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return map_arrow(docs.select(id_col, text_col), batch, schema, rows=500)


# --- the plan -------------------------------------------------------------------------------


class Complements:
    """Indexes of the sums that one, two or three available lengths make."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        self.single = self.counts > 0
        self.single[0] = False
        there = self.single.astype(np.float64)
        n = 2 * len(there)
        spectrum = np.fft.rfft(there, n)
        self.pair = np.rint(np.fft.irfft(spectrum * spectrum, n))[: len(there)] > 0
        self.triple = np.rint(np.fft.irfft(spectrum * np.fft.rfft(self.pair.astype(np.float64), n), n))[: len(there)] > 0

    def _fits(self, combo: tuple[int, ...]) -> bool:
        return all(self.counts[x] >= combo.count(x) for x in set(combo))

    def _pairs(self, gap: int, top: int):
        a = np.arange(min(gap - 1, top), (gap - 1) // 2, -1)
        for x in a[self.single[a] & self.single[gap - a]]:
            yield int(x), gap - int(x)

    def find(self, gap: int, used: tuple[int, ...]) -> tuple[int, ...] | None:
        """Available lengths that add up to `gap` beside those already used: the fewest, and of those the longest first."""
        if gap >= len(self.single):
            return None
        if self.single[gap] and self._fits((*used, gap)):
            return (gap,)
        if self.pair[gap]:
            for combo in self._pairs(gap, gap):
                if self._fits((*used, *combo)):
                    return combo
        if self.triple[gap]:
            a = np.arange(gap - 2, 0, -1)
            for x in a[self.single[a] & self.pair[gap - a]]:
                for rest in self._pairs(gap - int(x), int(x)):
                    if self._fits((*used, int(x), *rest)):
                        return (int(x), *rest)
        return None


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, repeats), ...) with the number of sequences that follow each."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def emit(combo: tuple[int, ...], times: int) -> None:
        plan.append((tuple((x, combo.count(x)) for x in sorted(set(combo), reverse=True)), times))

    index = Complements(left)
    residual: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while left[length]:
            if length == capacity:
                emit((length,), int(left[length]))
                left[length] = 0
                break
            combo = index.find(capacity - length, (length,))
            if combo is None:
                residual[length] = int(left[length])
                left[length] = 0
                break
            combo = (length, *combo)
            times = min(int(left[x]) // combo.count(x) for x in set(combo))
            for x in set(combo):
                left[x] -= times * combo.count(x)
            emit(combo, times)
            if any(not left[x] for x in combo):
                index.refresh()
        index.single[length] = False
    plan += best_fit(residual, capacity)
    return plan


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing over counted lengths; bins of one content are handled together."""
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    gaps: list[int] = []

    def put(gap: int, content: dict[int, int], times: int) -> None:
        if gap not in open_bins:
            open_bins[gap] = []
            gaps.insert(bisect_left(gaps, gap), gap)
        open_bins[gap].append((content, times))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * length, {length: each}, full)
                if rest:
                    put(capacity - rest * length, {length: rest}, 1)
                break
            gap = gaps[at]
            content, times = open_bins[gap].pop()
            each = min(gap // length, n)
            fill = min(times, n // each)
            if fill < times:
                open_bins[gap].append((content, times - fill))
            if not open_bins[gap]:
                del open_bins[gap]
                gaps.pop(at)
            put(gap - each * length, {**content, length: content.get(length, 0) + each}, fill)
            n -= each * fill
    return [(tuple(sorted(content.items(), reverse=True)), times) for group in open_bins.values() for content, times in group]


def slots(plan) -> dict[str, np.ndarray]:
    """For each (length, first number): where pieces numbered from there on go. Sorted by both."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, repeats in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, repeats, sequence, offset))
            taken[length] = first + repeats * times
            offset += repeats * length
        sequence += times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "repeats", "sequence", "offset"), columns, strict=True))


# --- the placement --------------------------------------------------------------------------


def _numbered(parts: DataFrame, counted: dict[int, int]) -> DataFrame:
    """Adds `__number`, from 0 within each length. counted: pieces of each length, which says how many groups each is dealt to.

    Groups and their number both grow with the root of a length's pieces, so
    neither numbering a group nor adding up the groups is ever one large task.
    They are dealt by row, as ids may repeat.
    """
    groups = [-(-counted.get(x, 0) // max(GROUP_PIECES, isqrt(counted.get(x, 0)))) or 1 for x in range(max(counted, default=0) + 1)]
    dealt = F.get(F.lit(groups).cast("array<bigint>"), F.col("length").cast("int"))
    salted = parts.withColumn("__row", F.monotonically_increasing_id()).withColumn("__salt", F.pmod(F.xxhash64("__row"), dealt))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(counts.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    own = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("__row"))
    numbered = salted.withColumn("__own", own).join(maybe_broadcast(starts, starts.count()), ["length", "__salt"])
    return numbered.withColumn("__number", F.col("__start") + F.col("__own") - 1).drop("__salt", "__own", "__start", "__row")


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`parts` (with doc_id, piece, length) and for each its sequence_id and offset. Read several times, so give a materialised frame.

    Full pieces are sequences of their own and need no place in the plan: they
    are numbered by row, behind the sequences of the plan.
    """
    counts = {int(r["length"]): int(r["count"]) for r in parts.groupBy("length").count().collect()}
    counts.pop(capacity, None)
    plan = make_plan(counts, capacity)
    where, planned = slots(plan), sum(times for _, times in plan)
    spread = np.int64(1) << np.int64(40)
    keys = where["length"] * spread + where["first"]
    names = parts.columns

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        number = b.column("__number").to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(keys, length * spread + number, side="right") - 1
        k, repeats = number - where["first"][at], where["repeats"][at]
        sequence = where["sequence"][at] + k // repeats
        offset = where["offset"][at] + k % repeats * length
        return pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in parts.dtypes) + ", sequence_id bigint, offset bigint"
    full = parts.where(F.col("length") == capacity).select(*names, (F.monotonically_increasing_id() + planned).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    if not counts:
        return full
    rest = _numbered(parts.where(F.col("length") < capacity), counts).select(*names, "__number")
    return map_arrow(rest, batch, schema, rows=50_000).unionByName(full)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return place(cut(pieces(docs, id_col, text_col, capacity, with_ids=with_ids)), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
ORACLES: dict[str, str] = {}
