"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file gives the vocabulary; every byte is shown to the library as one printable character, so the
library's character offsets are byte offsets, from which character offsets of the text follow. Pieces are cut by the pattern
first; a piece seen before is answered from a bounded cache, the others of about ``CHUNK`` characters of texts go to the library
in one call. The library's own threads are switched off in Spark's workers: tasks are parallel already.

Defined cases: a null or empty text has no ids and decodes to empty bytes; very long texts are encoded whole, in chunks that
end where the pattern always cuts; repeated rows are encoded again, each by itself; ties do not occur; a null id is carried along;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from strandlake.runtime import bounded_batches, giving_back

#: Pieces after which one Python worker starts a new generation of its cache (the last one is kept), and the longest piece that is kept.
CACHE_PIECES, CACHE_LENGTH = 100_000, 48
#: Characters of text that are cut into pieces at once.
CHUNK = 1 << 20


def byte_chars() -> list[str]:
    """The printable character of each byte: itself where Latin-1 prints it, else the next ones from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


class ByteBPE:
    def __init__(self, ranks_file: bytes, pattern: str):
        pairs = (line.split() for line in ranks_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = dict(map(reversed, self.ranks.items()))
        self.chars = byte_chars()
        self._latin = str.maketrans({chr(b): c for b, c in enumerate(self.chars)})
        show = lambda raw: raw.decode("latin-1").translate(self._latin)
        merges = [
            (show(t[:i]), show(t[i:]))
            for t in sorted(self.ranks, key=self.ranks.get)
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        model = models.BPE(vocab={show(t): r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)
        self.library = Tokenizer(model)
        self.pieces = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _shown(self, piece: str) -> str:
        return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._latin)

    def _packed(self, pieces: Sequence[str]) -> list[bytes]:
        """Little-endian ids of each piece."""
        cache, old = self.cache, self.old
        out = list(map(cache.get, pieces))
        gaps = [i for i, packed in enumerate(out) if packed is None]
        missing = {pieces[i] for i in gaps}
        new = [p for p in missing if p not in old]
        found = self.library.encode_batch_fast([self._shown(p) for p in new], add_special_tokens=False)
        cache.update((p, old[p]) for p in missing if p in old)
        cache.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(new, found, strict=True))
        for i in gaps:
            out[i] = cache[pieces[i]]
        for p in new:
            if len(p) > CACHE_LENGTH:
                del cache[p]
        if len(cache) > CACHE_PIECES:  # what is in use finds its way into the new generation
            self.old, self.cache = cache, {}
        return out

    def _cuts(self, text: str) -> Iterator[list[str]]:
        """Pieces of the text, at most about CHUNK characters at once; cut between a letter and white space that follows it."""
        at = 0
        while len(text) - at > 2 * CHUNK:
            end = next((m.start() for m in regex.finditer(r"(?<=\p{L})(?=\s[\p{L}\p{N}])", text, pos=at + CHUNK)), len(text))
            yield self.pieces(text[at:end])
            at = end
        yield self.pieces(text[at:])

    def encode_packed(self, text: str) -> bytes:
        return b"".join(b"".join(self._packed(pieces)) for pieces in self._cuts(text))

    def encode_many(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Little-endian ids of each text; short texts go together."""
        held: list[str] = []
        size = 0
        for text in texts:
            if len(text) > CHUNK:
                yield from self._together(held)
                yield self.encode_packed(text)
                held, size = [], 0
                continue
            held.append(text)
            size += len(text)
            if size > CHUNK:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: Sequence[str]) -> Iterator[bytes]:
        cut = [self.pieces(t) for t in texts]
        packed = iter(self._packed(list(chain.from_iterable(cut))))
        for pieces in cut:
            yield b"".join(islice(packed, len(pieces)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def encode_with_offsets(self, text: str) -> list[tuple[int, int, int]]:
        """``(id, start, end)`` with character offsets; a token that holds a part of a character covers that whole character."""
        char_of = np.repeat(np.arange(len(text)), [len(c.encode("utf-8", "surrogatepass")) for c in text]) if text else []
        out, at = [], 0
        for pieces in self._cuts(text):
            for piece in pieces:
                e = self.library.encode(self._shown(piece), add_special_tokens=False)
                out += [(i, int(char_of[at + s]), int(char_of[at + t - 1]) + 1) for i, (s, t) in zip(e.ids, e.offsets, strict=True)]
                at += len(piece.encode("utf-8", "surrogatepass"))
        return out

    def decode_bytes(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: Sequence[int]) -> str:
        """Text of the ids; a character whose bytes are split over tokens is put together, a broken one becomes U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_made: dict[int, ByteBPE] = {}


def _worker(key: int, ranks_file: bytes, pattern: str) -> ByteBPE:
    if key not in _made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _made.clear()
        _made[key] = ByteBPE(ranks_file, pattern)
    return _made[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, plus ``ids`` and the columns in ``keep`` if wanted.

    The rank file (a fixed vocabulary) is read on the driver and broadcast; executors need no file.
    """
    bounded_batches(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks_file = f.read()
    shared, key = docs.sparkSession.sparkContext.broadcast((ranks_file, pattern)), zlib.crc32(ranks_file + pattern.encode())
    kept = [c for c in keep if c not in ("doc_id", "text")]
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    types = dict(docs.dtypes)
    schema += "".join(f", `{c}` {types[c]}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(key, *shared.value)
        for batch in batches:
            n, a, b, ids = [], [], [], []
            for packed in bpe.encode_many([t or "" for t in batch.column("text").to_pylist()]):
                found = np.frombuffer(packed, dtype="<u4")
                n.append(len(found))
                a.append(hashlib.sha256(packed).hexdigest())
                seen = hashlib.sha256()
                for i in range(0, len(found), CHUNK):
                    seen.update(bpe.decode_bytes(found[i : i + CHUNK].tolist()))
                b.append(seen.hexdigest())
                if with_ids:
                    ids.append(found.astype(np.int32))
            out = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            out += [pa.array(ids, pa.list_(pa.int32()))] * with_ids + [batch.column(c) for c in kept]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + kept
            yield pa.RecordBatch.from_arrays(out, names=names)

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    return picked.mapInArrow(giving_back(run), schema)
