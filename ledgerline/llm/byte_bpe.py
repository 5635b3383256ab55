"""Byte-level BPE encoding and decoding by DuckDB recursive queries within each partition.

A text is split by a pattern; each distinct piece of a block of texts becomes rows
(word, position, token) that a recursive query joins with the merge table, contracting in each
word the leftmost pair of least rank until no pair of the word is in the table.  Decoding joins
token ids with their bytes, which are put one behind the other in the order of positions.

The merge table holds every split of a vocabulary entry into two others, so pairs merge by the
rank of their joined bytes, as the rank file means it.  Pieces longer than ``LONG_WORD`` bytes
are contracted step by step in one table instead of a recursion that keeps all its states, and
each step takes the occurrences of the least pair from the left up to the first one whose
merging makes a pair of lower rank, which is what one at a time would do.

Memory is bounded: texts are taken in blocks of bytes, words in blocks of bytes, and the pieces
remembered by a task are dropped when they exceed ``REMEMBERED``.  The rank file is read on the
driver and broadcast (its size is that of the vocabulary).  A lost task is run again from its
input.

Defined results: a null or empty text has no tokens; special tokens don't exist; repeated rows
get equal results; an empty table gives no rows; the other columns stay, and a new column gets
another name if its name is taken.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import fresh, slices, whole_text
from ledgerline.session import ship_functions

BLOCK_BYTES = 2 << 20
BLOCK_IDS = 1 << 18
WORD_BYTES = 1 << 18
LONG_WORD = 64
REMEMBERED = 300_000
MEMORY = "200MB"

ship_functions(__name__)
ship_functions("ledgerline.llm.common")

RECURSION = """
WITH RECURSIVE state(word, pos, id, next_pos, next_id, fixed) AS (
  SELECT word, pos, id, next_pos, next_id, false FROM token_rows
  UNION ALL
  (WITH ranked AS (
     SELECT s.word, s.pos, s.id, s.next_pos, s.next_id, m.id AS merged
     FROM state s LEFT JOIN merges m ON m.left_id = s.id AND m.right_id = s.next_id WHERE NOT s.fixed),
   least AS (
     SELECT word, min(merged::BIGINT * 1048576 + pos) AS pair FROM ranked WHERE merged IS NOT NULL GROUP BY word),
   pairs AS (
     SELECT a.word, a.merged, a.pos, b.pos AS gone, b.next_pos, b.next_id
     FROM least JOIN ranked a ON a.word = least.word AND a.pos = least.pair % 1048576
     JOIN ranked b ON b.word = a.word AND b.pos = a.next_pos)
   SELECT r.word, r.pos,
     CASE WHEN r.pos = p.pos THEN p.merged ELSE r.id END,
     CASE WHEN r.pos = p.pos THEN p.next_pos ELSE r.next_pos END,
     CASE WHEN r.pos = p.pos THEN p.next_id WHEN r.next_pos = p.pos THEN p.merged ELSE r.next_id END,
     p.word IS NULL
   FROM ranked r LEFT JOIN pairs p ON r.word = p.word WHERE p.word IS NULL OR r.pos <> p.gone))
SELECT word, id FROM state WHERE fixed ORDER BY word, pos
"""

#: One step for long words: state (word, pos, id) to (word, pos, id, changed).
STEP = """
WITH placed AS (
  SELECT word, pos, id, row_number() OVER w AS n, lag(id) OVER w AS before,
    lead(id) OVER w AS next_id, lead(id, 2) OVER w AS after FROM state WINDOW w AS (PARTITION BY word ORDER BY pos)),
ranked AS (
  SELECT p.*, m.id AS merged, min(m.id) OVER (PARTITION BY word) AS least
  FROM placed p LEFT JOIN merges m ON m.left_id = p.id AND m.right_id = p.next_id),
found AS (
  SELECT *, n - row_number() OVER (PARTITION BY word ORDER BY pos) AS run FROM ranked WHERE merged = least),
taken AS (
  SELECT *, lag(n) OVER (PARTITION BY word ORDER BY pos) AS last FROM (
    SELECT *, (n - min(n) OVER (PARTITION BY word, run)) % 2 AS odd FROM found) WHERE odd = 0),
lower AS (
  SELECT t.word, min(t.n) AS n FROM taken t
  LEFT JOIN merges a ON a.left_id = CASE WHEN t.last = t.n - 2 THEN t.least ELSE t.before END AND a.right_id = t.least
  LEFT JOIN merges b ON b.left_id = t.least AND b.right_id = t.after
  WHERE a.id < t.least OR b.id < t.least GROUP BY t.word),
done AS (SELECT t.word, t.n, t.merged FROM taken t LEFT JOIN lower l USING (word) WHERE l.n IS NULL OR t.n <= l.n)
SELECT r.word, r.pos, coalesce(d.merged, r.id) AS id, d.merged IS NOT NULL AS changed
FROM ranked r LEFT JOIN done d ON d.word = r.word AND d.n = r.n
LEFT JOIN done g ON g.word = r.word AND g.n = r.n - 1 WHERE g.word IS NULL
"""

DECODING = "SELECT place, piece FROM encoded JOIN pieces USING (id)"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def splits_of(ranks: dict[bytes, int]) -> np.ndarray:
    """Ranks of the two parts and of the whole, as three rows, for every split of an entry into two others."""
    splits = [
        (ranks[p[:i]], ranks[p[i:]], rank) for p, rank in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks
    ]
    return np.array(splits, np.int32).reshape(-1, 3).T


def _connection():
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute(f"SET memory_limit = '{MEMORY}'")
    return con


class Encoder:
    """Encodes blocks of texts; remembers the pieces that it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, splits: np.ndarray | None = None):
        import pyarrow as pa
        import regex

        self.find = regex.compile(pattern).findall
        self.single = np.zeros(256, np.int32)
        for piece, rank in ranks.items():
            if len(piece) == 1:
                self.single[piece[0]] = rank
        self.con = _connection()
        self.con.register("splits", pa.table(dict(zip(("left_id", "right_id", "id"), splits_of(ranks) if splits is None else splits))))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM splits")
        self.con.unregister("splits")
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.starts, self.ids = [np.zeros(1, np.int64)], [np.empty(0, np.int32)]

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts and their ids."""
        if len(self.code) > REMEMBERED:
            self.forget()
        pieces = [self.find(t) if t else [] for t in texts]
        self._learn(list(set(chain.from_iterable(pieces)).difference(self.code)))
        starts, ids = np.concatenate(self.starts), np.concatenate(self.ids)
        self.starts, self.ids = [starts], [ids]
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(pieces)), np.int64, sum(map(len, pieces)))
        counts = starts[codes + 1] - starts[codes]
        ends = np.cumsum(counts)
        taken = ids[np.repeat(starts[codes] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        words = np.cumsum([0, *map(len, pieces)])
        return np.concatenate([[0], ends])[words], taken

    def _learn(self, words: list[str]) -> None:
        held: list[tuple[str, bytes]] = []
        size = 0
        for w in sorted(words, key=len):
            raw = w.encode("utf-8", "surrogatepass")
            if held and (size + len(raw) > WORD_BYTES or len(raw) > LONG_WORD >= len(held[0][1])):
                self._contract(held)
                held, size = [], 0
            held.append((w, raw))
            size += len(raw)
        if held:
            self._contract(held)

    def _contract(self, words: list[tuple[str, bytes]]) -> None:
        import pyarrow as pa

        lengths = np.array([len(raw) for _, raw in words])
        data = self.single[np.frombuffer(b"".join(raw for _, raw in words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        if lengths.max() > LONG_WORD:
            found = self._step_by_step(pa.table({"word": word, "pos": pos, "id": data}))
        else:
            last = np.append(word[1:] != word[:-1], True)
            self.con.register("token_rows", pa.table({
                "word": word, "pos": pos, "id": data, "next_pos": np.where(last, -1, pos + 1).astype(np.int32),
                "next_id": np.where(last, -1, np.append(data[1:], -1)).astype(np.int32),
            }))
            found = self.con.execute(RECURSION).fetchnumpy()
            self.con.unregister("token_rows")
        counts = np.bincount(found["word"], minlength=len(words))
        first = len(self.code)
        for i, (w, _) in enumerate(words):
            self.code[w] = first + i
        self.starts.append(self.starts[-1][-1] + np.cumsum(counts))
        self.ids.append(np.asarray(found["id"], np.int32))

    def _step_by_step(self, rows) -> dict[str, np.ndarray]:
        self.con.register("token_rows", rows)
        self.con.execute("CREATE OR REPLACE TABLE state AS SELECT *, true AS changed FROM token_rows")
        self.con.unregister("token_rows")
        while self.con.execute("SELECT count(*) FROM state WHERE changed").fetchone()[0]:
            self.con.execute(f"CREATE TABLE following AS {STEP}")
            self.con.execute("DROP TABLE state")
            self.con.execute("ALTER TABLE following RENAME TO state")
        return self.con.execute("SELECT word, id FROM state ORDER BY word, pos").fetchnumpy()


def _encoding(batches: Iterator, shared, pattern: str, text_col: str, name: str) -> Iterator:
    """Batches with the token ids of the text as one more column; ``shared`` has the ranks and their splits."""
    import pyarrow as pa

    encoder = None
    for batch in batches:
        if encoder is None:
            ranks, splits = shared.value
            encoder = Encoder(ranks, pattern, splits)
        for part in slices(batch, text_col, BLOCK_BYTES):
            offsets, ids = encoder.block(part.column(text_col).to_pylist())
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, listed], names=[*part.schema.names, name])


def _bytes_of(con, ids):
    """The bytes of each list of ids: one flat list is joined with the pieces, whose places then part the texts again."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths, flat = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), ids.flatten()
    con.register("encoded", pa.table({"place": np.arange(len(flat)), "id": flat}))
    found = con.sql(DECODING).to_arrow_table()
    con.unregister("encoded")
    place = found["place"].to_numpy()
    before = np.zeros(len(flat) + 1, np.int64)
    before[place + 1] = pc.binary_length(found["piece"]).to_numpy()
    offsets = np.cumsum(before)[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]
    ordered = found["piece"].combine_chunks().take(pa.array(np.argsort(place, kind="stable")))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), ordered.buffers()[2]])


def _decoding(batches: Iterator, shared, ids_col: str, name: str) -> Iterator:
    """Batches with the bytes that the ids stand for as one more column."""
    import pyarrow as pa

    con = None
    for batch in batches:
        if con is None:
            con = _connection()
            pieces = shared.value[0]
            con.register("vocabulary", pa.table({"id": pa.array(pieces.values(), pa.int32()), "piece": pa.array(pieces, pa.binary())}))
            con.execute("CREATE TABLE pieces AS SELECT * FROM vocabulary")
            con.unregister("vocabulary")
        lengths = batch.column(ids_col).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(lengths) - lengths) // BLOCK_IDS
        edges = [0, *(np.nonzero(np.diff(block))[0] + 1), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            part = batch.slice(start, end - start)
            yield pa.RecordBatch.from_arrays([*part.columns, _bytes_of(con, part.column(ids_col))], names=[*part.schema.names, name])


def _with_column(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*frame.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", name: str = "ids") -> tuple[DataFrame, str]:
    """The frame with one more column, the token ids of the text as array<int>; and its name."""
    (name,) = fresh(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, splits_of(ranks)))
    return docs.mapInArrow(
        lambda batches: _encoding(batches, shared, pattern, text_col, name), _with_column(docs, name, T.ArrayType(T.IntegerType()))), name


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", name: str = "decoded") -> tuple[DataFrame, str]:
    """The frame with one more column, the bytes that the ids stand for; and its name."""
    (name,) = fresh(encoded, name)
    shared = encoded.sparkSession.sparkContext.broadcast((ranks, splits_of(ranks)))
    return encoded.mapInArrow(
        lambda batches: _decoding(batches, shared, ids_col, name), _with_column(encoded, name, T.BinaryType())), name


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows of the kept columns, ids and decoded: both steps in one pass, so each task has one Python process."""
    ranks = read_ranks(path)
    only = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], whole_text(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast((ranks, splits_of(ranks)))
    kept = only.drop("_text")
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        encoded = (b.drop_columns(["_text"]) for b in _encoding(batches, shared, pattern, "_text", "ids"))
        return _decoding(encoded, shared, "ids", "decoded")

    return only.mapInArrow(run, schema).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded")
