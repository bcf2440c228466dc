"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

In each partition the texts are cut into the matches of the tokenizer's
pattern. A match that is itself in the vocabulary is its own token. The rest,
each distinct one once, go to DuckDB as token-position rows (word, position,
token). One recursive step joins neighbouring tokens with the merge table,
takes each word's leftmost pair of minimum rank, contracts it, and repeats
until no pair of the word is in the table. Decoding joins ids with the
vocabulary and puts the bytes together by ordered aggregation.

Encoded pieces are kept from batch to batch in the worker, up to
`CACHE_PIECES` pieces and `CACHE_CHARS` characters; when more have come, the
store starts anew. A query takes words up to `SQUARES`, so memory stays bounded
however large the partition is and however long its words are. A null text
counts as empty: no ids, no bytes. Pieces of more than `LONG` bytes, which no
prose holds, would need a step for each byte and are contracted in the same
order with a heap. Empty tables give empty results; repeated rows and null ids
are encoded row by row, other columns are ignored. Whole texts are encoded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, table

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 1_100_000
#: Characters kept for pieces and segments.
CACHE_CHARS = 150_000_000
#: Words to a recursive query, and the sum of their squared lengths, as the query makes a row for each token and step.
WORDS, SQUARES = 50_000, 100_000_000
#: Bytes beyond which a piece is merged with a heap instead: the query contracts one pair a step, so its time grows with the square (0.6 s for 4000 bytes, against 0.01 s).
LONG = 1024
#: Documents that are encoded together.
BATCH = 500

#: A space before a character that is no white space starts a new match whatever stands around it.
_CUT_TWICE = re.compile(r" (?:\s|$)")

#: Spreads (rank, position) over one integer, so that its minimum is the leftmost pair of least rank.
_KEY = "merged::BIGINT * 1099511627776 + pos"

ENCODE = f"""
WITH RECURSIVE state(word, pos, token, next, nextpos, merged, done) AS (
    SELECT s.word, s.pos, s.token, s.next, s.nextpos, m.merged, false
    FROM (
      SELECT word, pos, token, lead(token) OVER w AS next, lead(pos) OVER w AS nextpos
      FROM spelled WINDOW w AS (PARTITION BY word ORDER BY pos)
    ) s LEFT JOIN merges m ON m.a = s.token AND m.b = s.next
  UNION ALL
    SELECT n.word, n.pos, n.token, n.next, n.nextpos, m.merged, n.done
    FROM (
      SELECT s.word, s.pos,
             CASE WHEN s.pos = best.pos THEN best.token ELSE s.token END AS token,
             CASE WHEN s.pos = best.pos THEN best.next WHEN s.nextpos = best.pos THEN best.token ELSE s.next END AS next,
             CASE WHEN s.pos = best.pos THEN best.nextpos ELSE s.nextpos END AS nextpos,
             best.word IS NULL AS done
      FROM (SELECT * FROM state WHERE NOT done) s
      LEFT JOIN (
        SELECT x.word, x.pos, x.token, y.pos AS gone, y.next, y.nextpos
        FROM (
          SELECT word, arg_min(pos, {_KEY}) AS pos, arg_min(merged, {_KEY}) AS token, arg_min(nextpos, {_KEY}) AS gone
          FROM state WHERE NOT done AND merged IS NOT NULL GROUP BY word
        ) x JOIN (SELECT * FROM state WHERE NOT done) y ON y.word = x.word AND y.pos = x.gone
      ) best ON best.word = s.word
      WHERE best.word IS NULL OR s.pos <> best.gone
    ) n LEFT JOIN merges m ON m.a = n.token AND m.b = n.next
)
SELECT word, pos, token FROM state WHERE done
"""

DECODE = """
SELECT c.word, string_agg(c.token::VARCHAR, ' ' ORDER BY c.pos) AS ids, string_agg(v.hexed, '' ORDER BY c.pos) AS hexed
FROM coded c JOIN vocabulary v ON v.token = c.token
GROUP BY c.word
"""


class Codec:
    """Vocabulary, merge table and DuckDB connection of one worker."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._store("merges", dict(zip(("a", "b", "merged"), (np.array(x, dtype=np.int32) for x in zip(*pairs, strict=True)), strict=True)))
        tokens = sorted((rank, t) for t, rank in self.ranks.items())
        self._store("vocabulary", {"token": np.array([x for x, _ in tokens], dtype=np.int32), "hexed": [t.hex() for _, t in tokens]})
        self.pieces: dict[str, tuple[str, bytes]] = {}
        self.plain: dict[str, tuple[str, bytes]] = {}
        self.spaced: dict[str, tuple[str, bytes]] = {}
        self.chars = 0

    def _store(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same contraction for one long piece: linked tokens and a heap of pairs by (rank, place)."""
        token = [int(self.single[c]) for c in raw]
        part = [raw[i : i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
        end, heap = len(raw), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < end and (rank := self.ranks.get(part[i] + part[after[i]])) is not None:
                heapq.heappush(heap, (rank, i, len(part[i]), len(part[after[i]])))

        for i in range(end - 1):
            offer(i)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            if not part[i] or len(part[i]) != x or after[i] >= end or len(part[after[i]]) != y:
                continue
            j = after[i]
            token[i], part[i], part[j], after[i] = rank, part[i] + part[j], b"", after[j]
            if after[i] < end:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [t for t, p in zip(token, part, strict=True) if p]

    def _coded(self, names: list[str], word: np.ndarray, pos: np.ndarray, token: np.ndarray) -> None:
        """Keep the ids of words, and the bytes that they decode to."""
        self._store("coded", {"word": word, "pos": pos, "token": token})
        for w, ids, hexed in self.db.execute(DECODE).fetchall():
            self.pieces[names[w]] = (ids, bytes.fromhex(hexed))
            self.chars += len(ids) + len(hexed)

    def encode_pieces(self, pieces: list[str]) -> None:
        """Fill `pieces` for distinct pieces: the whole piece's rank, or the merges' fixpoint."""
        whole, spell, long = [], [], []
        for p in pieces:
            raw = p.encode("utf-8", "surrogatepass")
            (whole if raw in self.ranks else spell if len(raw) <= LONG else long).append((p, raw))
        zeros = np.zeros(len(whole), dtype=np.int32)
        self._coded([p for p, _ in whole], np.arange(len(whole), dtype=np.int32), zeros, np.array([self.ranks[raw] for _, raw in whole], dtype=np.int32))
        for p, raw in long:
            ids = np.array(self._merge_long(raw), dtype=np.int32)
            self._coded([p], np.zeros(len(ids), dtype=np.int32), np.arange(len(ids), dtype=np.int32), ids)
        spell.sort(key=lambda x: len(x[1]))
        squares = np.cumsum([len(raw) ** 2 for _, raw in spell])
        at = 0
        while at < len(spell):
            before = squares[at - 1] if at else 0
            end = max(at + 1, min(at + WORDS, int(np.searchsorted(squares, before + SQUARES, side="right"))))
            part, at = spell[at:end], end
            lengths = np.array([len(raw) for _, raw in part])
            word = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            pos = (np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            token = self.single[np.frombuffer(b"".join(raw for _, raw in part), dtype=np.uint8)]
            self._store("spelled", {"word": word, "pos": pos, "token": token})
            out = self.db.execute(ENCODE).fetchnumpy()
            self._coded([p for p, _ in part], out["word"], out["pos"], out["token"])

    def segments(self, text: str) -> tuple[list[str], list[str]]:
        """Parts of a text whose matches do not depend on each other: first parts as they are, then parts that a space goes before."""
        if not text:
            return [], []
        if _CUT_TWICE.search(text):
            return self.pattern.findall(text), []
        first, *rest = text.split(" ")
        return [first] if first else [], rest

    def _learn(self, store: dict, segments: list[str], before: str) -> None:
        cut = [self.pattern.findall(before + s) for s in segments]
        self.encode_pieces(list({p for c in cut for p in c}.difference(self.pieces)))
        known = self.pieces
        for s, c in zip(segments, cut, strict=True):
            got = [known[p] for p in c]
            store[s] = got[0] if len(got) == 1 else (" ".join([x for x, _ in got]), b"".join([x for _, x in got]))
            self.chars += 8 * len(s)

    def run(self, texts: list[str | None]) -> list[tuple[str, bytes]]:
        """Ids, joined by spaces, and decoded bytes of each text."""
        out: list[tuple[str, bytes]] = []
        cut = [self.segments(t or "") for t in texts]
        if len(self.plain) + len(self.spaced) > CACHE_PIECES or len(self.pieces) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.plain, self.spaced, self.pieces, self.chars = {}, {}, {}, 0
        for store, k, before in ((self.plain, 0, ""), (self.spaced, 1, " ")):
            new: set[str] = set()
            for c in cut:
                new.update(set(c[k]).difference(store))
            if new:
                self._learn(store, list(new), before)
        plain, spaced = self.plain, self.spaced
        for first, rest in cut:
            got = [plain[s] for s in first] + [spaced[s] for s in rest]
            out.append((" ".join([x for x, _ in got]), b"".join([x for _, x in got])))
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row for each row of `docs`: id, the ids joined by spaces, and the bytes decoded from them."""
    return _map(docs, id_col, text_col, vocabulary, "ids string, decoded binary", lambda ids, raw: (ids, raw), [pa.string(), pa.binary()])


def _map(docs, id_col, text_col, vocabulary, schema, finish, types) -> DataFrame:
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = dict(docs.dtypes)[id_col]
    names = ["doc_id", *[x.split()[0] for x in schema.split(", ")]]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [finish(ids, raw) for ids, raw in codec(path).run(b.column(1).to_pylist())]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([b.column(0), *columns], names)

    return map_arrow(docs.select(id_col, text_col), batch, f"doc_id {kind}, {schema}", rows=BATCH)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(ids: str, raw: bytes):
        n = ids.count(" ") + 1 if ids else 0
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()

    docs = table(spark, sf_dir, "documents")
    return _map(docs, "doc_id", "text", None, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest, [pa.int64(), pa.string(), pa.string()])


QUERIES = {"op9_byte_bpe": op9_byte_bpe}
ORACLES: dict[str, str] = {}
