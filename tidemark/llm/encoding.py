"""Token ids of a whole corpus by a public byte-level BPE vocabulary."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.bpe import TrieEncoder, read_ranks

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
PIECES_KEPT = 400_000
TEXTS_AT_ONCE = 256
#: a line break before a visible character is a word by itself, and no word reaches across it
LINE = re.compile(r"\n(?=\S)")
BLANKS = re.compile(r"\s\s|[^\S ]")
#: so is a single blank between visible characters, which belongs to the word after it
BLANK = re.compile(r"(?<=\S) (?=\S)")
#: in scripts without blanks, a letter or digit after a punctuation mark begins a word
MARK = re.compile(r"(?<=[。，；：、？！”」』）])(?=[^\W_])")

_encoders: dict[str, "CorpusEncoder"] = {}


class CorpusEncoder:
    """Encodes texts by pieces: stretches between single blanks, each encoded once and then looked up."""

    def __init__(self, ranks: dict[bytes, int]):
        self.trie = TrieEncoder(ranks)
        self.break_id = self.trie.encode(["\n"])[0]
        self.pieces: dict[str, bytes] = {}
        self.after_blank: dict[str, bytes] = {}  # the same for pieces after a blank, which is not in the key

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed 4-byte ids of each text; those of a null or empty text are empty."""
        out: list[bytes] = []
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            out += self._encode(texts[i : i + TEXTS_AT_ONCE])
        return out

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        known, after = self.pieces, self.after_blank
        if len(known) + len(after) > PIECES_KEPT:
            known.clear()
            after.clear()
        out: list[list[bytes]] = []
        waiting: list[tuple[list[bytes], int, list[str], dict[str, bytes]]] = []
        for text in texts:
            ids: list[bytes] = []
            for line in LINE.split(text) if text else ():
                first, rest, table = self._cut(line)
                try:
                    ids.append(known[first] + b"".join([table[p] for p in rest]))
                except KeyError:
                    waiting.append((ids, len(ids), [first, *rest], table))
                    ids.append(b"")
            out.append(ids)
        self._learn({p for _, _, pieces, table in waiting for p in (pieces[:1] if table is after else pieces)}, known, "")
        self._learn({p for _, _, pieces, table in waiting if table is after for p in pieces[1:]}, after, " ")
        for ids, at, (first, *rest), table in waiting:
            ids[at] = known[first] + b"".join([table[p] for p in rest])
        return [self.break_id.join(ids) for ids in out]

    def _learn(self, pieces: set[str], table: dict[str, bytes], lead: str) -> None:
        new = list(pieces - table.keys())
        table.update(zip(new, self.trie.encode([lead + p for p in new])))

    def _cut(self, line: str) -> tuple[str, list[str], dict[str, bytes]]:
        """A line's first piece, the others, and the table that holds those; cut where a word begins whatever stands around."""
        if " " not in line:
            first, *rest = (line,) if line.isascii() else MARK.split(line)
            return first, rest, self.pieces
        odd = BLANKS.search(line) or line[:1] == " " or line[-1:] == " "
        first, *rest = BLANK.split(line) if odd else line.split(" ")
        return first, rest, self.after_blank


def small_batches(spark: SparkSession) -> None:
    """Let texts travel to Python 1,000 rows at a time, unless the session asks for another number than Spark's default."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def encoder(path: str) -> CorpusEncoder:
    """The encoder of a vocabulary file, one per Python worker."""
    if path not in _encoders:
        _encoders[path] = CorpusEncoder(read_ranks(path))
    return _encoders[path]


def token_ids(docs: DataFrame, ident: str, text: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(ident, ids): the token ids of each text, without special tokens.

    The text of a special token is ordinary text. Null and empty texts have no ids (an empty list). No shuffle: every
    task walks the trie of the distinct words it meets. ``vocabulary`` must be readable under this path on every executor.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(ident, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            packed = enc.encode(batch.column(1).to_pylist())
            ends = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=ends[1:])
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], [ident, "ids"])

    schema = T.StructType([rows.schema[ident], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def token_counts(docs: DataFrame, ident: str, text: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(ident, tokens): the number of token ids of each text; 0 for null and empty texts."""
    small_batches(docs.sparkSession)
    rows = docs.select(ident, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            packed = enc.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64())], [ident, "tokens"])

    return rows.mapInArrow(run, T.StructType([rows.schema[ident], T.StructField("tokens", T.LongType())]))
