"""Exact encoding with a merge-type SentencePiece model, by backtracking, and decoding.

A merge encoding is the only split of a text into self-encoding pieces in which each two
neighbours stay apart when they are merged on their own. The encoder finds it from left
to right: an Aho-Corasick automaton gives all pieces that start at each position, the
longest is tried first, a neighbour check merges the pair anew (kept by pair of ids), and
a bitfield marks positions from which no valid split went on, so that none is tried twice.

No piece has a space symbol after another character, and line breaks are in no piece at
all; texts are cut there, and the split of a short unit is kept in a bounded memo. Long
units are encoded all the same, whole. Characters that no piece has go to byte ids.

Null texts are empty ones; empty texts give only the begin and end ids; long ones are encoded
whole. Every row gives one, repeated ones too; an empty table gives none. Extra columns go.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

SPACE = "▁"
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Units, characters of a unit, and checked pairs up to which a Python worker keeps them.
MEMO_UNITS, MEMO_CHARS, MEMO_PAIRS = 500_000, 48, 300_000


class Encoder:
    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {sp.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.bytes and i not in self.control and not sp.is_unknown(i) and not sp.is_unused(i)}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces with inner spaces or line breaks aren't supported")
        self.chars = {p for p in self.ids if len(p) == 1}
        if any(not self.chars.issuperset(p) for p in self.ids):
            raise ValueError("pieces with characters that are no pieces aren't supported")
        self.most = max(map(len, self.ids))
        self.whole = {p: i for p, i in self.ids.items() if self.merged(p) == [p]}  # an encoding has no others
        self.sizes = [len(p) for p in self.pieces]
        self.shorter = [next((self.whole[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.whole), -1) for p in self.pieces]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.whole.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.apart: dict[tuple[int, int], bool] = {}
        self.memo = Memo(self)
        self.begin, self.end = (int(i).to_bytes(4, "little") for i in (self.bos, self.eos))
        # a piece's text by id where that is all; not so the unknown piece and parts of characters
        self.easy = ["" if i in self.control else chr(self.bytes[i]) if i in self.bytes else p for i, p in enumerate(self.pieces)]
        self.hard = np.array([i == self.unk or self.bytes.get(i, 0) > 127 for i in range(n)])

    def merged(self, text: str) -> list[str]:
        """The merges themselves: best score first, then leftmost. For short texts."""
        parts, get, none = list(text), self.scores.get, -1e30
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k < len(scores):
                scores[k] = get(parts[k] + parts[k + 1], none)
            if k:
                scores[k - 1] = get(parts[k - 1] + parts[k], none)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        if len(self.apart) >= MEMO_PAIRS:
            self.apart.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self.apart[left, right] = self.merged(a + b) == [a, b]
        return known

    def longest(self, text: str, pos: int) -> int:
        """The id of the longest piece at a place: the automaton's path from there, cut back to a piece."""
        text = text[pos : pos + self.most]
        size = self.automaton.longest_prefix(text)
        while (i := self.whole.get(text[:size])) is None:
            size -= 1
        return i

    def _known(self, text: str) -> list[int]:
        """The split of a text all of whose characters are in pieces."""
        n, sizes, shorter, apart = len(text), self.sizes, self.shorter, self.apart
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        pos, i = 0, self.longest(text, 0)
        while pos < n:
            while i >= 0:
                end = pos + sizes[i]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not out or (known := apart.get((out[-1], i))):
                        break
                    if known is None and self.compatible(out[-1], i):
                        break
                i = shorter[i]
            if i >= 0:
                out.append(i)
                pos = end
                if pos < n:
                    i = self.longest(text, pos)
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                i = out.pop()
                pos -= sizes[i]
                i = shorter[i]
        return out

    def unit(self, text: str) -> list[int]:
        """Ids of a unit; characters in no piece go to the ids of their bytes."""
        if self.chars.issuperset(text):
            return self._known(text)
        out, run = [], []
        for c in text:
            if c in self.chars:
                run.append(c)
            else:
                if run:
                    out += self._known("".join(run))
                    run = []
                out += [self.byte_ids[b] for b in c.encode()]
        return out + self._known("".join(run)) if run else out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with those of begin and end."""
        units = UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []
        return b"".join([self.begin, *map(self.memo.__getitem__, units), self.end])

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces with spaces restored, runs of byte ids as UTF-8."""
        ids = np.frombuffer(ids, "<u4")
        if not self.hard[ids].any():
            return "".join(map(self.easy.__getitem__, ids.tolist())).removeprefix(SPACE).replace(SPACE, " ")
        out, run, first = [], bytearray(), True
        for i in ids.tolist():
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if i in self.control:
                continue
            if run:
                out.append(utf8(run))
                run, first = bytearray(), False
            p = self.pieces[i] if i != self.unk else " ⁇ "
            if first:
                p, first = p.removeprefix(SPACE), False
            out.append(p)
        if run:
            out.append(utf8(run))
        return "".join(out).replace(SPACE, " ")


class Memo(dict):
    """Encodings of units; long ones aren't kept, and a full memo starts anew."""

    def __init__(self, enc: Encoder):
        super().__init__()
        self.enc = enc

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.enc.unit(unit), "<u4").tobytes()
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = ids
        return ids


def utf8(run: bytearray) -> str:
    """Bytes as text; each byte outside valid characters becomes one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, k = [], 0
    while k < len(run):
        for size in range(1, 5):
            try:
                out.append(run[k : k + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        k += size
    return "".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(model_file: str) -> Encoder:
    if model_file not in _encoders:
        _encoders[model_file] = Encoder(model_file)
    return _encoders[model_file]


def encode_texts(docs: DataFrame, model_file: str, keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary), decoded, and digests of both."""
    kept = [n for n, k in (("ids", keep_ids), ("decoded", keep_text)) if k]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join({"ids": ", ids binary", "decoded": ", decoded string"}[k] for k in kept)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}

    def run(batches):
        enc = encoder(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [enc.encode(t.as_py() or "") for t in part.column(1)]
                texts = [enc.decode(x) for x in ids]
                cols = {
                    "doc_id": part.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": texts,
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in texts],
                }
                yield pa.RecordBatch.from_arrays([cols[n].cast(kinds[n]) if isinstance(cols[n], pa.Array) else pa.array(cols[n], kinds.get(n, pa.string())) for n in names], names=names)

    return shared.small_batches(shared.with_columns(docs, "doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(shared.table(spark, sf_dir, "documents"), default_model(), keep_ids=False, keep_text=False)
