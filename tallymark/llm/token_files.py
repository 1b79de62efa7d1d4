"""Token ids of all documents as files: a concatenated id array with Elias-Fano boundaries.

A shard file holds, little-endian: the magic, the id width in bytes, the numbers of documents,
of those without an id, and of token ids, the least doc_id, the doc_ids, the boundaries, and
the token ids. Doc_ids and boundaries are Elias-Fano sequences: the low-bit width, the low
bits packed, the high bits in unary, and samples of every 64th one among the high bits for
select. The boundary of document i is select(i): n documents over u ids take about
n * (2 + log2(u / n)) bits, without a table of 64-bit offsets.

Documents are dealt out by ranges of doc_id (null first), a digest of the text and the row, so
that neither repeated ids nor repeated rows pile up in one task, and lie in that order. A
shard holds documents of about shard_bytes. Files take a fresh name per attempt and the
manifest lists those of attempts that ended well. Null and empty texts give the end id only;
long ones are whole. An empty table gives no files; extra columns go.

Texts are cut as the vocabulary cuts them, each piece is looked up among those that a worker
has met, and new pieces of letters are encoded together. That is for vocabularies of the
known kind only (see KNOWN); with any other, whole texts go to the library.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

MAGIC = b"TLYTOK02"
HEADER = struct.Struct("<8sBQQQq")
SAMPLE = 64
#: Pieces that a Python worker keeps encoded; and the longest of them.
MEMO_PIECES, MEMO_BYTES = 800_000, 48
#: The normaliser and the cuts of the vocabulary whose pieces can be encoded alone.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


class EliasFano:
    """A non-decreasing sequence of integers below a known end, with constant-time select."""

    def __init__(self, low: np.ndarray, high: np.ndarray, samples: np.ndarray, width: int, n: int):
        self.low, self.high, self.samples, self.width, self.n = low, high, samples, width, n

    @classmethod
    def build(cls, values: np.ndarray, end: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        width = max(0, int(end // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4") if n else np.empty(0, "<u4"), width, n)

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th one among the high bits, from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        bits = np.unpackbits(self.high[byte : byte + 16], bitorder="little")
        ones = np.flatnonzero(bits[at & 7 :])
        size = 16
        while len(ones) <= left:
            size *= 4
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + size], bitorder="little")[at & 7 :])
        return ((at + int(ones[left]) - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.width:
            return 0
        start = i * self.width
        raw = int.from_bytes(self.low[start >> 3 : (start + self.width + 7) >> 3].tobytes(), "little")
        return (raw >> (start & 7)) & ((1 << self.width) - 1)

    def all(self) -> np.ndarray:
        """Every value, in order."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.zeros(self.n, np.int64)
        if self.width:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.width].reshape(self.n, self.width)
            low = bits.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))
        return ((ones - np.arange(self.n)) << self.width) | low


    def write(self, out) -> None:
        out.write(struct.pack("<B", self.width))
        for part in (self.low, self.high, self.samples):
            raw = part.tobytes()
            out.write(struct.pack("<Q", len(raw)))
            out.write(raw)

    @classmethod
    def read(cls, file, n: int) -> EliasFano:
        width = file.read(1)[0]
        low, high, samples = (file.read(struct.unpack("<Q", file.read(8))[0]) for _ in range(3))
        return cls(np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4"), width, n)


def write_shard(out, doc_ids: list, ids: list[bytes], id_bytes: int) -> int:
    """Write documents' ids, each given as unsigned 32-bit integers, with doc_ids in order, null first; the count of all ids."""
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    total = int(lengths.sum())
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    out.write(HEADER.pack(MAGIC, id_bytes, len(ids), len(ids) - len(known), total, least))
    above = np.array([d - least for d in known], np.uint64)
    EliasFano.build(above, int(above[-1]) + 1 if known else 0).write(out)
    EliasFano.build(np.cumsum(lengths), total + 1).write(out)
    for x in ids:
        values = np.frombuffer(x, "<u4")
        if len(values) and int(values.max()) >> (8 * id_bytes):
            raise ValueError("an id is too large for the file's id width")
        out.write(values.astype(f"<u{id_bytes}").tobytes())
    return total


class Shard:
    """A shard file, of which only the index is read at first."""

    def __init__(self, file):
        self.file = file
        magic, self.id_bytes, self.n, self.nulls, self.total, self.least = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.known = EliasFano.read(file, self.n - self.nulls)
        self.ends = EliasFano.read(file, self.n)
        self.data = file.tell()

    @property
    def doc_ids(self) -> list:
        return [None] * self.nulls + [self.least + d for d in self.known.all().astype(np.uint64).tolist()]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.known.select(i - self.nulls)

    def bounds(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        self.file.seek(self.data + start * self.id_bytes)
        return np.frombuffer(self.file.read((end - start) * self.id_bytes), f"<u{self.id_bytes}")

    def __iter__(self):
        """(doc_id, start, ids) of all documents, in one pass over the file."""
        self.file.seek(self.data)
        start = 0
        for doc_id, end in zip(self.doc_ids, self.ends.all().tolist()):
            yield doc_id, start, np.frombuffer(self.file.read((end - start) * self.id_bytes), f"<u{self.id_bytes}")
            start = end


#: Of ISO 8859-1: lower case, and the vocabulary's cuts, whose letters, numbers and white space are these there.
_LOWER = bytes(c + 32 if 65 <= c <= 90 or 192 <= c <= 222 and c != 215 else c for c in range(256))
_L, _N, _S = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe", rb"\t-\r \x85\xa0"
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[%b]+|[%b]|[^%b%b%b]+" % (_L, _N, _S, _L, _N))
_IS_LETTER = [bool(re.fullmatch(rb"[%b]" % _L, bytes([c]))) for c in range(256)]


def pieces_of(text: str) -> list:
    """What can be encoded alone: the vocabulary's cuts, as bytes of ISO 8859-1, of a text of these characters.

    Of others, runs between ASCII white space, as strings; these hold no cut of the vocabulary's
    in part. Special tokens are matched before any cut, so texts that may have some are one piece.
    """
    if "<|" in text:
        return [text]
    try:
        return PIECES.findall(text.encode("latin-1").translate(_LOWER))
    except UnicodeEncodeError:
        return [c.decode() for c in text.encode().split()]


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class PieceMemo(dict):
    """Ids, as bytes, of pieces."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        spec = json.loads(self.tokenizer.to_str())
        suffix, vocab = spec["model"].get("end_of_word_suffix"), self.tokenizer.get_vocab()
        self.known = all(spec[k] == v for k, v in KNOWN.items()) and spec["model"]["type"] == "BPE" and bool(suffix) and all("<|" in t["content"] for t in spec["added_tokens"])
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        # for pieces of letters, which are in their normal form: the same model, with cuts at spaces alone
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, KNOWN["pre_tokenizer"]["pretokenizers"][1]]}
        self.plain = Tokenizer.from_str(json.dumps(spec)) if self.known else None

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encodings of pieces of letters, from one text; told apart by ids that end a word."""
        ids = np.array(self.plain.encode_batch_fast([b" ".join(words).decode("latin-1")], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.last[ids]) + 1) * 4
        if len(ends) != len(words) or ends[-1] != ids.nbytes:
            return {}
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, [0, *ends[:-1].tolist()], ends.tolist())}

    def _new(self, pieces: list) -> dict:
        """Encodings of pieces; those that aren't long are kept, and a full memo starts anew."""
        words, out = [c for c in pieces if type(c) is bytes and _IS_LETTER[c[0]]], {}
        for at in range(0, len(words), 1024):
            out |= self._words(words[at : at + 1024])
        rest = [c for c in pieces if c not in out] if len(out) < len(pieces) else []
        texts = [c.decode("latin-1") if type(c) is bytes else c for c in rest]
        out |= zip(rest, (packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))
        if len(self) + len(out) > MEMO_PIECES:
            self.clear()
        self.update((c, ids) for c, ids in out.items() if len(c) <= MEMO_BYTES)
        return out

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        if not self.known:
            return [packed(e.ids) + end for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [pieces_of(t) for t in texts]
        flat = list(chain.from_iterable(split))
        ids = list(map(self.get, flat))
        if None in ids:
            gaps = [k for k, x in enumerate(ids) if x is None]
            new = self._new(list({flat[k] for k in gaps}))
            for k in gaps:
                ids[k] = new[flat[k]]
        out, at = [], 0
        for s in split:
            out.append(b"".join([*ids[at : at + len(s)], end]))
            at += len(s)
        return out


_memos: dict[str, PieceMemo] = {}


def memo_of(tokenizer_file: str) -> PieceMemo:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if tokenizer_file not in _memos:
        _memos[tokenizer_file] = PieceMemo(tokenizer_file)
    return _memos[tokenizer_file]


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 2, id_bytes: int = 2, shard_bytes: int = 32 << 20) -> list[tuple[str, int]]:
    """Write shard files; their names and first offsets, in doc_id order. The driver holds a row per shard."""
    docs = shared.small_batches(shared.with_columns(docs, "doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keyed = docs.withColumns({"key": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), "key", "row"]
    ordered = keyed.repartitionByRange(max(1, -(-size // shard_bytes)), *order).sortWithinPartitions(*order).select("doc_id", "text")
    end = struct.pack("<I", end_id)

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        memo, part, number = memo_of(tokenizer_file), TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0

        def put():
            name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.tok"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
                total = write_shard(out, doc_ids, ids, id_bytes)
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number]), pa.array([name]), pa.array([total])], names=["part", "number", "name", "total"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                encoded = memo.encode([t or "" for t in some.column("text").to_pylist()], end)
                doc_ids += some.column("doc_id").to_pylist()
                ids += encoded
                held += sum(map(len, encoded))
                if held >= 2 * shard_bytes:  # ranges are of rows, and may hold more bytes than meant
                    yield put()
                    doc_ids, ids, held, number = [], [], 0, number + 1
        if ids:
            yield put()

    manifest = sorted(map(tuple, ordered.mapInArrow(run, "part long, number long, name string, total long").collect()))
    out, start = [], 0
    for *_, name, total in manifest:
        out.append((name, start))
        start += total
    fs, base = pafs.FileSystem.from_uri(path)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/manifest.tsv", compression=None) as f:
        f.write("".join(f"{n}\t{s}\n" for n, s in out).encode())
    return out


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    fs, base = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{base}/manifest.tsv", compression=None) as f:
        files = [(n, int(s)) for n, s in (line.split("\t") for line in f.read().decode().splitlines())]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first").to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as f:
                    rows = [(d, first + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, start, ids in Shard(f)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame(files, "name string, first long")
    return listed.repartition(max(1, len(files))).mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.scratch(spark, "tokens")
    write_tokens(shared.table(spark, sf_dir, "documents"), default_tokenizer(), path)
    return read_tokens(spark, path)
