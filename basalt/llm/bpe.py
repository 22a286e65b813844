"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside Spark tasks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice
from operator import itemgetter

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import kept

#: White space as the tokenizers' pattern means it: the Unicode property, in place of ``\s``.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Distinct words that a Python worker remembers in a generation, and characters taken at once.
CACHE, CHUNK = 450_000, 3_000_000
#: Bytes of a word from which it is contracted over tables that hold only the live state, and
#: rows that all rounds of the recursion may leave for the shorter ones, at most.
LONG, ROUND_ROWS = 256, 4_000_000

#: One contraction a word and round: its leftmost pair of the least rank, until none is left.
_ENCODE = """
WITH RECURSIVE state AS (
    SELECT w, pos, id, 0 AS round FROM start
    UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT s.*, m.merged, m.merged::BIGINT * 4294967296 + s.pos AS here
        FROM (
            SELECT *, lead(id) OVER row AS next_id, lead(pos) OVER row AS next_pos
            FROM state WINDOW row AS (PARTITION BY w ORDER BY pos)
        ) s
        LEFT JOIN merges m ON m.first_id = s.id AND m.second_id = s.next_id
    ), best AS (
        SELECT w, min(here) AS least, arg_min(next_pos, here) AS gone FROM pairs WHERE here IS NOT NULL GROUP BY w
    )
    SELECT p.w, p.pos, CASE WHEN p.here = b.least THEN p.merged ELSE p.id END, p.round + 1
    FROM pairs p JOIN best b USING (w) WHERE p.pos <> b.gone)
)
SELECT w, pos, id FROM state JOIN (SELECT w, max(round) AS round FROM state GROUP BY w) USING (w, round)
"""
#: One round over table ``live``: of each word all pairs of its least rank, from the left and
#: not overlapping, up to the first whose new neighbours would pair at a lesser rank. Words
#: without a pair go to table ``settled``.
_ROUND = """
CREATE OR REPLACE TEMP TABLE pairs AS
    SELECT s.*, m.merged, min(m.merged) OVER (PARTITION BY s.w) AS least
    FROM (
        SELECT w, pos, id, row_number() OVER row AS place, lag(id) OVER row AS prior_id, lead(id) OVER row AS next_id, lead(id, 2) OVER row AS next_but_one
        FROM live WINDOW row AS (PARTITION BY w ORDER BY pos)
    ) s
    LEFT JOIN merges m ON m.first_id = s.id AND m.second_id = s.next_id;
INSERT INTO settled SELECT w, pos, id FROM pairs WHERE least IS NULL;
CREATE OR REPLACE TEMP TABLE taken AS
    WITH hit AS (
        SELECT w, place, prior_id, next_but_one, merged, place - row_number() OVER (PARTITION BY w ORDER BY place) AS run FROM pairs WHERE merged = least
    ), apart AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY place) AS nth FROM hit) WHERE nth % 2 = 1
    ), beside AS (
        SELECT *, CASE WHEN lag(place) OVER (PARTITION BY w ORDER BY place) = place - 2 THEN merged ELSE prior_id END AS left_id FROM apart
    ), judged AS (
        SELECT b.w, b.place, b.merged, min(b.place) FILTER (l.merged < b.merged OR r.merged < b.merged) OVER (PARTITION BY b.w) AS until
        FROM beside b
        LEFT JOIN merges l ON l.first_id = b.left_id AND l.second_id = b.merged
        LEFT JOIN merges r ON r.first_id = b.merged AND r.second_id = b.next_but_one
    )
    SELECT w, place, merged FROM judged WHERE until IS NULL OR place <= until;
CREATE OR REPLACE TEMP TABLE live AS
    SELECT p.w, p.pos, coalesce(t.merged, p.id) AS id
    FROM pairs p LEFT JOIN taken t ON t.w = p.w AND t.place = p.place LEFT JOIN taken g ON g.w = p.w AND g.place + 1 = p.place
    WHERE p.least IS NOT NULL AND g.place IS NULL;
"""
_DECODE = "SELECT w, string_agg(hex(v.bytes), '' ORDER BY t.pos) AS text FROM tokens t JOIN vocabulary v USING (id) GROUP BY w ORDER BY w"


class ByteBPE:
    """A vocabulary of ranks in a DuckDB database of the task's own."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]"))
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        first, second, merged = (pa.array(c, pa.int32()) for c in zip(*pairs))
        self.db = duckdb.connect(config={"threads": "1", "memory_limit": "500MB", "temp_directory": ""})
        incoming = pa.table({"first_id": first, "second_id": second, "merged": merged})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})
        self.db.register("incoming", incoming)
        self.db.register("words", vocabulary)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM incoming; CREATE TABLE vocabulary AS SELECT * FROM words")
        self.db.unregister("incoming")
        self.db.unregister("words")

    def decode(self, w: np.ndarray, pos: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The bytes of each sequence ``w``, its tokens in order of ``pos``."""
        self.db.register("tokens", pa.table({"w": w, "pos": pos, "id": ids}))
        texts = self.db.execute(_DECODE).fetchall()
        self.db.unregister("tokens")
        return [bytes.fromhex(x) for _, x in texts]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (word number, position, token id) of non-empty ``words``, in order."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(raw), dtype=np.int64) - starts[w]).astype(np.int32)
        ids = self.byte_ids[raw]
        # Batches of short words whose rounds leave a bounded number of rows, then the long words.
        short = np.where(sizes < LONG, sizes * (sizes + 1) // 2, 0)
        batch = np.where(sizes < LONG, (np.cumsum(short) - short) // ROUND_ROWS, -1)[w]
        found = [(np.zeros(0, np.int32),) * 3]
        for number in np.unique(batch):
            mine = batch == number
            self.db.register("start", pa.table({"w": w[mine], "pos": pos[mine], "id": ids[mine]}))
            out = self.db.execute(_ENCODE).fetchnumpy() if number >= 0 else self.contract()
            self.db.unregister("start")
            found.append(tuple(np.asarray(out[c]) for c in ("w", "pos", "id")))
        w, pos, ids = map(np.concatenate, zip(*found))
        order = np.lexsort((pos, w))
        return w[order], pos[order], ids[order]

    def contract(self) -> dict[str, np.ndarray]:
        """The tokens of the words in ``start``, round by round over tables."""
        self.db.execute("CREATE OR REPLACE TEMP TABLE live AS SELECT * FROM start; CREATE OR REPLACE TEMP TABLE settled AS SELECT * FROM live WHERE false")
        while self.db.execute("SELECT count(*) FROM live").fetchone()[0]:
            self.db.execute(_ROUND)
        return self.db.execute("SELECT w, pos, id FROM settled").fetchnumpy()

    def learn(self, words: list[str]) -> None:
        """Encode and decode the words that are not remembered yet."""
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            w, pos, ids = self.encode([x.encode() for x in part])
            texts = self.decode(w, pos, ids)
            packed, ends = ids.astype("<u4").tobytes(), np.cumsum(np.bincount(w, minlength=len(part))) * 4
            begin = 0
            for word, end, text in zip(part, ends.tolist(), texts):
                self.known[word] = (packed[begin:end], text)
                begin = end

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches, in lists of a bounded size."""
        if len(text) <= CHUNK:
            yield self.pattern.findall(text)
            return
        found = (m[0] for m in self.pattern.finditer(text))
        while part := list(islice(found, CHUNK // 4)):
            yield part

    def coded(self, parts: list[list[str]]) -> Iterator[tuple[bytes, bytes]]:
        """For each list of matches, its ids as little-endian 32-bit integers and its bytes."""
        words = set().union(*parts)
        if len(self.known) + len(words) > CACHE:  # what is not used again until the next time goes
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        words.difference_update(known)
        missing = []
        for word in words:
            found = older.get(word)
            if found is None:
                missing.append(word)
            else:
                known[word] = found
        if missing:
            self.learn(sorted(missing))
        for part in parts:
            found = list(map(known.__getitem__, part))
            yield b"".join(map(itemgetter(0), found)), b"".join(map(itemgetter(1), found))


def loaded(path: str, pattern: str) -> ByteBPE:
    """The vocabulary, kept by the Python worker from task to task."""
    return kept(("bpe", path, pattern), lambda: ByteBPE(path, pattern))


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded), one per document.

    ``ids`` holds the token ids of the whole text as little-endian 32-bit integers, ``decoded``
    the bytes those ids stand for. Each match of ``pattern`` is a word; rows (word, position,
    token) join the merge table and a recursive query contracts each word's leftmost pair of
    least rank until nothing changes (words of ``LONG`` bytes and more keep only their live rows
    between rounds); an ordered aggregation over the token rows decodes. Words
    are remembered within bounds, and long texts go through in pieces. A null or empty text has
    no tokens; repeated rows and null doc_ids keep a row each; further columns play no part; an
    empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path, pattern)

        def out(ids: list, texts: list[str]) -> pa.RecordBatch:
            codes, bytes_of = [b""] * len(texts), [b""] * len(texts)
            held: list[tuple[int, list[str]]] = []
            size = 0

            def flush() -> None:
                for (i, _), (code, text) in zip(held, coder.coded([part for _, part in held])):
                    codes[i] += code
                    bytes_of[i] += text

            for i, text in enumerate(texts):
                for part in coder.pieces(text):
                    held.append((i, part))
                    size += min(len(text), CHUNK)
                    if size >= CHUNK:
                        flush()
                        held, size = [], 0
            flush()
            counts = pa.array([len(x) // 4 for x in codes], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(ids, key_type), counts, pa.array(codes, pa.binary()), pa.array(bytes_of, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

        for batch in batches:
            key_type = batch.column(0).type
            ids, texts, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                ids.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield out(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield out(ids, texts)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded binary")


def decode_ids(rows: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (key, text): the texts of arrays of token ids; null ids give a null text."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path, pattern)
        for batch in batches:
            sequences = batch.column(1).to_pylist()
            full = [i for i, x in enumerate(sequences) if x]
            texts: list[str | None] = [None if x is None else "" for x in sequences]
            if full:
                sizes = np.array([len(sequences[i]) for i in full])
                w = np.repeat(np.arange(len(full), dtype=np.int32), sizes)
                pos = np.arange(len(w), dtype=np.int32)
                for i, text in zip(full, coder.decode(w, pos, np.concatenate([sequences[i] for i in full]).astype(np.int32))):
                    texts[i] = text.decode("utf-8", errors="replace")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return rows.select(key, ids).mapInArrow(run, f"{key} {kind}, text string")


def bpe_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode_decode(docs, path, pattern)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
