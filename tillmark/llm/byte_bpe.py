"""Byte-level BPE encoding and decoding by recursive DuckDB queries in every partition.

A rank file names byte strings by rank; the pattern cuts a text into pieces, and
each piece is encoded apart. Texts are cut before white space into parts; Arrow
numbers the distinct parts of a slice, so only these meet the pattern, and each
text's ids are taken from them. The distinct pieces that are not yet known become
rows with the list of their tokens, at first one a byte, and the list of ranks of
neighbours. In every round a recursive query contracts each piece's leftmost pair
of least rank and joins the new token and its two neighbours with the merge table,
until no piece has a pair that merges. A piece that is itself a token is that
token at once.

Decoding joins rows (text, position, id) with the vocabulary and aggregates them
in order. Byte strings are Latin-1 text inside DuckDB, one character a byte.

Pieces above ``WINDOW`` bytes are cut into windows that overlap by half, encoded
as above and joined at a token that both windows have. That is exact: a sequence
of tokens is the encoding of its bytes if every two neighbours are, and each
pair of neighbours then lies inside one window. Where two windows share no token
the next window starts at a token border instead, and grows if need be up to the
whole piece.

The vocabulary is read on the driver and travels with the job (about 2.5 MB for
50,000 tokens), so executors need no copy of the file.

Defined results: null and empty texts have no ids and decode to no bytes; a null
``doc_id`` stays null; repeated rows are encoded alike; other columns are left
out, so their names cannot clash; an empty table gives an empty table; an id
outside the vocabulary or a null id stops decoding with a ``ValueError``.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Pieces and parts of texts remembered by a task; beyond that only those of the slice at hand are kept.
REMEMBERED = 400_000
# Text bytes encoded together: the more, the fewer queries.
ENCODED_BYTES = 4 << 20
# Bytes of a window, a multiple of all sizes of a character twice over.
WINDOW = 384
# Positions that one recursive query holds, and tokens that one decoding query holds.
POSITIONS, TOKENS = 500_000, 400_000
# White space of one byte, and longer white space by the Unicode property. A text may be cut before each run of it.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]

_MERGES = """
CREATE TABLE merges AS SELECT l.id * 1048576 + r.id AS pair, w.id::INTEGER AS merged
FROM (SELECT id, bytes, unnest(range(1, length(bytes))) AS cut FROM vocabulary) w
JOIN vocabulary l ON l.bytes = w.bytes[:cut] JOIN vocabulary r ON r.bytes = w.bytes[cut + 1:]
"""

# A rank that no pair has.
_NONE = 1 << 30
# ranks[i]: rank of what tokens i and i + 1 merge to. The first place of the least rank is the leftmost pair of least rank.
_ENCODE = f"""
WITH RECURSIVE state(word, tokens, ranks, best) AS (
  SELECT word, tokens, ranks, list_min(ranks) FROM start
  UNION ALL
  SELECT word, tokens, ranks, list_min(ranks) FROM (
    SELECT word, tokens[:i - 1] || [best] || tokens[i + 2:] AS tokens,
      CASE WHEN i = 1 THEN [after] ELSE ranks[:i - 2] || [before, after] END || ranks[i + 2:] AS ranks
    FROM (
      SELECT s.*, coalesce(l.merged, {_NONE}::INTEGER) AS before, coalesce(r.merged, {_NONE}::INTEGER) AS after
      FROM (SELECT *, list_position(ranks, best) AS i FROM state WHERE best < {_NONE}) s
      LEFT JOIN merges l ON l.pair = tokens[i - 1] * 1048576::BIGINT + best
      LEFT JOIN merges r ON r.pair = best * 1048576::BIGINT + tokens[i + 2]
    )
  )
) SELECT word, tokens FROM state WHERE best = {_NONE} ORDER BY word
"""

_DECODE = """
SELECT t.text_row, array_to_string(list(v.bytes ORDER BY t.position), '') AS bytes
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY t.text_row ORDER BY t.text_row
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file; every single byte must have one."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if any(bytes([b]) not in ranks for b in range(256)) or max(ranks.values()) >= 1 << 20:
        raise ValueError("a rank file names all single bytes, and ranks stay below 2^20")
    return ranks


def _connect() -> duckdb.DuckDBPyConnection:
    settings = {"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False}
    return duckdb.connect(config=settings)


def _vocabulary(ranks: dict[bytes, int]) -> pa.Table:
    return pa.table({"id": pa.array(ranks.values(), pa.int64()), "bytes": [b.decode("latin-1") for b in ranks]})


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Pairs of tokens whose bytes together are a token, with that token's rank."""
    database = _connect()
    database.register("ranked", _vocabulary(ranks))
    database.execute("CREATE TABLE vocabulary AS FROM ranked")
    database.execute(_MERGES)
    return database.sql("FROM merges").to_arrow_table()


class Codec:
    """Encodes pieces and decodes ids with one DuckDB database."""

    def __init__(self, ranks: dict[bytes, int], merges: pa.Table, pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        every = [bytes([b]) for b in range(256)]
        self.byte_tokens = np.array([ranks[b] for b in every], np.int32)
        self.byte_ranks = np.array([ranks.get(a + b, _NONE) for a in every for b in every], np.int32)
        self.database = _connect()
        for name, rows in (("vocabulary", _vocabulary(ranks)), ("merges", merges)):
            self.database.register("given", rows)
            self.database.execute(f"CREATE TABLE {name} AS FROM given")
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    # ------------------------------------------------------------------ encoding

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of 32-bit integers."""
        raw = [t.encode() for t in texts]
        borders, cuts = np.cumsum([0, *map(len, raw)]), _cuts(raw)
        found = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(b"".join(raw)))
        coded = found.dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [part for part in parts if part not in self.parts]
        pieces: list[str] = []
        ends = []
        for part in new:
            pieces += self.pattern.findall(part)
            ends.append(len(pieces))
        needed = set(pieces)
        if len(self.pieces) > REMEMBERED:
            self.pieces = {piece: self.pieces[piece] for piece in needed.intersection(self.pieces)}
        self._learn(needed.difference(self.pieces))
        ids = list(map(self.pieces.__getitem__, pieces))
        for part, a, b in zip(new, [0, *ends], ends):
            self.parts[part] = ids[a] if b - a == 1 else b"".join(ids[a:b])
        known = list(map(self.parts.__getitem__, parts))
        if len(self.parts) > REMEMBERED:
            self.parts = dict(zip(parts, known))
        lists = _id_lists(known).take(coded.indices)
        values = lists.values.to_numpy()
        at = lists.offsets.to_numpy()[np.searchsorted(cuts, borders)].tolist()
        return [values[a:b].tobytes() for a, b in zip(at, at[1:])]

    def _learn(self, pieces: set[str]) -> None:
        new, words = [], []
        for piece in pieces:
            word = piece.encode()
            rank = self.ranks.get(word)
            if rank is not None:
                self.pieces[piece] = np.int32(rank).tobytes()
            elif len(word) <= WINDOW:
                new.append(piece)
                words.append(word)
            else:
                self.pieces[piece] = self._encode_long(word).tobytes()
        self.pieces.update(zip(new, self.contract(words)))

    def contract(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of each word, in recursive queries of a bounded number of bytes."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends, start = np.cumsum(sizes), 0
        while start < len(words):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + POSITIONS, side="right")))
            raw = np.frombuffer(b"".join(words[start:stop]), np.uint8)
            offsets = np.append(0, ends[start:stop] - before)
            ranks = self.byte_ranks[raw * np.int64(256) + np.append(raw[1:], np.uint8(0))]
            ranks[offsets[1:] - 1] = _NONE
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x)) for x in (self.byte_tokens[raw], ranks)]
            self.database.register("start", pa.table([pa.array(np.arange(stop - start)), *lists], ["word", "tokens", "ranks"]))
            found = self.database.sql(_ENCODE).to_arrow_table().column("tokens").combine_chunks()
            borders = (4 * found.offsets.to_numpy()).tolist()
            ids = found.values.to_numpy().astype(np.int32).tobytes()
            yield from (ids[a:b] for a, b in zip(borders, borders[1:]))
            start = stop

    def _encode_long(self, word: bytes) -> np.ndarray:
        """Tokens of a long word from overlapping windows; window by window where two of them share no token."""
        step = WINDOW // 2
        starts = range(0, len(word) - step, step)
        done = next(spans := self._spans(word, starts, WINDOW))
        for span in spans:
            common = np.intersect1d(_border_codes(done), _border_codes(span))
            if not len(common):
                return self._encode_in_order(word)
            begin = common[-1] >> 12
            done = np.concatenate([done[done[:, 0] < begin], span[span[:, 0] >= begin]])
        return done[:, 2].astype(np.int32)

    def _spans(self, word: bytes, starts: Iterable[int], size: int) -> Iterator[np.ndarray]:
        """Rows (begin, end, token) of the windows of a word."""
        starts = list(starts)
        for start, ids in zip(starts, self.contract([word[s : s + size] for s in starts])):
            tokens = np.frombuffer(ids, np.int32)
            ends = start + np.cumsum([len(self._bytes(t)) for t in tokens])
            yield np.stack([np.concatenate([[start], ends[:-1]]), ends, tokens], axis=1)

    def _bytes(self, token: int) -> bytes:
        if not hasattr(self, "bytes_of"):
            self.bytes_of = {rank: piece for piece, rank in self.ranks.items()}
        return self.bytes_of[int(token)]

    def _encode_in_order(self, word: bytes) -> np.ndarray:
        """As ``_encode_long``, but each window starts at a border of the one before and must begin with its token."""
        size = WINDOW
        done = next(self._spans(word, [0], size))
        while done[-1, 1] < len(word):
            # the border from which the next window is to agree
            keep = max(1, int(np.searchsorted(done[:, 0], done[-1, 1] - size // 2, side="right")) - 1)
            start = int(done[keep, 0]) if keep < len(done) else int(done[-1, 0])
            span = next(self._spans(word, [start], size)) if size <= 1000 else self._whole(word, start)
            same = np.flatnonzero(np.all(span[0] == done, axis=1))
            if len(same) and (span[-1, 1] > done[-1, 1]):
                done = np.concatenate([done[: same[0]], span])
            elif size > 1000:
                return self._whole(word, 0)[:, 2].astype(np.int32)
            else:
                size *= 2
        return done[:, 2].astype(np.int32)

    def _whole(self, word: bytes, start: int) -> np.ndarray:
        """Plain merging of the rest of a word, for vocabularies whose windows never agree."""
        tokens = [bytes([b]) for b in word[start:]]
        while True:
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))]
            least = min(((r, i) for r, i in ranked if r is not None), default=None)
            if least is None:
                break
            tokens[least[1] : least[1] + 2] = [tokens[least[1]] + tokens[least[1] + 1]]
        ends = start + np.cumsum([len(t) for t in tokens])
        return np.stack([np.concatenate([[start], ends[:-1]]), ends, [self.ranks[t] for t in tokens]], axis=1)

    # ------------------------------------------------------------------ decoding

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids. A long list is decoded in parts, which changes nothing."""
        parts = [(row, ids[i : i + TOKENS]) for row, ids in enumerate(lists) for i in range(0, len(ids), TOKENS)]
        decoded: list[list[bytes]] = [[] for _ in lists]
        start = 0
        while start < len(parts):
            stop, size = start, 0
            while stop < len(parts) and (stop == start or size + len(parts[stop][1]) <= TOKENS):
                size += len(parts[stop][1])
                stop += 1
            ids = np.concatenate([ids for _, ids in parts[start:stop]]).astype(np.int64)
            sizes = [len(ids) for _, ids in parts[start:stop]]
            table = pa.table({"text_row": np.repeat(np.arange(start, stop), sizes), "position": np.arange(len(ids)), "id": ids})
            if not np.all(np.isin(ids, self._ids())):
                raise ValueError("an id is not in the vocabulary")
            self.database.register("tokens", table)
            found = self.database.sql(_DECODE).to_arrow_table()
            for number, text in zip(found.column("text_row").to_pylist(), found.column("bytes").to_pylist()):
                decoded[parts[number][0]].append(text.encode("latin-1"))
            start = stop
        return [b"".join(x) for x in decoded]

    def _ids(self) -> np.ndarray:
        if not hasattr(self, "known_ids"):
            self.known_ids = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        return self.known_ids


def _cuts(texts: list[bytes]) -> np.ndarray:
    """Borders of the parts of some texts laid end to end: those of the texts, and each begin of a run of white space."""
    codes = np.frombuffer(b"".join(texts), np.uint8)
    space = _SPACE[codes]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    # What follows longer white space goes on with a run. Runs that begin with it stay uncut, which changes no id.
    odd = np.flatnonzero(codes[at - 1] >= 128)
    goes_on = np.zeros(len(odd), bool)
    for wide in _WIDE:
        matches = at[odd] >= len(wide)
        for back, byte in enumerate(reversed(wide), 1):
            matches &= codes[at[odd] - back] == byte
        goes_on |= matches
    border = np.zeros(len(codes) + 1, bool)
    border[np.delete(at, odd[goes_on])] = True
    border[np.cumsum([0, *map(len, texts)])] = True
    return np.flatnonzero(border)


def _border_codes(span: np.ndarray) -> np.ndarray:
    """Begin and size of each token in one number, for comparing windows of the same word."""
    return span[:, 0] << 12 | span[:, 1] - span[:, 0]


def _codec(path: str, pattern: str) -> Callable[[], Codec]:
    ranks = read_ranks(path)
    merges = merge_table(ranks)
    return lambda: Codec(ranks, merges, pattern)


def _id_lists(encoded: list[bytes]) -> pa.ListArray:
    ids = np.frombuffer(b"".join(encoded), np.int32)
    ends = np.cumsum([0, *map(len, encoded)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of each document: doc_id, ids."""
    codec = _codec(path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec()
        for batch in slices(batches, "text", ENCODED_BYTES):
            ids = _id_lists(coder.encode([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Bytes of rows (doc_id, ids), beside the ids."""
    codec = _codec(path, r"[\s\S]")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec()
        for batch in batches:
            lists = [np.array([] if ids is None else ids, np.float64) for ids in batch.column("ids").to_pylist()]
            if any(np.isnan(ids).any() for ids in lists):
                raise ValueError("an id is null")
            decoded = pa.array(coder.decode(lists), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), decoded], ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of each document and the bytes they decode to, in one pass: doc_id, ids, decoded."""
    codec = _codec(path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec()
        for batch in slices(batches, "text", ENCODED_BYTES):
            encoded = coder.encode([t or "" for t in batch.column("text").to_pylist()])
            decoded = pa.array(coder.decode([np.frombuffer(x, np.int32) for x in encoded]), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _id_lists(encoded), decoded], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(trips: DataFrame) -> DataFrame:
    """Number of ids and SHA-256 of the ids (decimal, one space between) and of the decoded bytes."""
    return trips.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
