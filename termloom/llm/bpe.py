"""Byte-level BPE with content-defined chunk reuse.

Texts are cut where a rolling hash of the last 32 bytes says so, so that passages which documents share give the
same chunks wherever they stand.  Each distinct chunk is encoded once by a worker and kept in a bounded cache; its ids serve all
documents that hold it.  A join of two chunks may lie inside a pre-token, so the text around it is encoded again:
between the nearest positions, on either side, at which the pre-tokenizer must begin a new token (a single
space between two visible ASCII characters).  If a chunk's tokens do not end exactly there, the stretch is widened, until both
sides agree.  The result equals encoding the whole text at once.

The two installed encoders with this vocabulary agree on Latin text and the faster one is used there; a stretch that
holds other scripts or is very long goes to the ``tokenizers`` library itself.

Defined results: a null or empty text has no tokens and decodes to the empty text; repeated rows repeat; a special token's
string in a text gives its id, as in the library's default.
"""

from __future__ import annotations

import base64
import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.shared import give_back, small_batches
from termloom.llm.tokens import _BYTES, BLOCK, U, byte_table, mix, text_buffer

#: bytes that the rolling hash sees, mean length of a chunk (a power of two), bytes of cached chunks in a worker
WINDOW, MEAN, CACHE_BYTES = 32, 1024, 48 << 20
#: a stretch of more bytes than this goes to the library with the better worst case
LONG = 8192


class Encoder:
    """Encodes and decodes Arrow text columns with one vocabulary. json_path, ranks_path: the same vocabulary in both formats."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str, special: dict[str, int]) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.allowed = set(special)
        self.exact = Tokenizer.from_file(json_path)
        self.exact.no_truncation()
        self.exact.no_padding()
        pieces = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        self.lengths = np.zeros(max(pieces) + 1, dtype=np.int64)
        for i, b in pieces.items():
            self.lengths[i] = len(b)
        self.at = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(len(self.lengths))), dtype=np.uint8)
        self.cache: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.held = self.reused = self.encoded = 0
        self.table = byte_table(77)

    def plain(self, text: bytes) -> np.ndarray:
        """The ids of a stretch of text, encoded by itself."""
        if len(text) > LONG or max(text, default=0) >= 0xCA:
            return np.array(self.exact.encode(text.decode(), add_special_tokens=False).ids, dtype=np.int32)
        return np.array(self.fast.encode(text.decode(), allowed_special=self.allowed, disallowed_special=()), dtype=np.int32)

    def chunk(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A chunk's ids and the byte positions at which its tokens begin and end; encoded once, then reused."""
        if (found := self.cache.get(text)) is not None:
            self.reused += 1
            self.cache.move_to_end(text)
            return found
        ids = self.plain(text)
        found = ids, np.concatenate([[0], np.cumsum(self.lengths[ids])]).astype(np.int32)
        self.encoded += 1
        self.cache[text] = found
        self.held += 8 * len(ids) + len(text) + 400
        while self.held > CACHE_BYTES:
            old, (gone, _) = self.cache.popitem(last=False)
            self.held -= 8 * len(gone) + len(old) + 400
        return found

    def cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Content-defined positions: those after whose WINDOW last bytes a chunk ends; never inside a character."""
        n = len(raw)
        if n <= WINDOW:
            return np.zeros(0, dtype=np.int64)
        up, down = _BYTES.get(n + 1)
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(self.table[raw] * up[:n], out=total[1:])
        rolled = mix((total[WINDOW:] - total[:-WINDOW]) * down[: n + 1 - WINDOW])
        at = np.flatnonzero((rolled & U(MEAN - 1)) == 0) + WINDOW
        at = at[(at < n)]
        at = at[(raw[at] & 0xC0) != 0x80]
        row = np.searchsorted(offsets, at, side="right") - 1
        return at[at - offsets[row] >= WINDOW]

    def safe(self, raw: np.ndarray) -> np.ndarray:
        """Positions before a single space between two visible ASCII characters: a pre-token always begins there."""
        seen = (raw > 0x20) & (raw < 0x7F)
        return np.flatnonzero(seen[:-2] & (raw[1:-1] == 0x20) & seen[2:]) + 1 if len(raw) > 2 else np.zeros(0, dtype=np.int64)

    def encode_text(self, text: bytes, cuts: list[int], safe: np.ndarray) -> np.ndarray:
        """The ids of one text, from those of its chunks; cuts and safe are positions in it."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        edges = [0, *cuts, len(text)]
        out, done, k = [], 0, 0
        while done < len(text):
            while edges[k + 1] <= done:
                k += 1
            a, b = edges[k], edges[k + 1]
            ids, ends = self.chunk(text[a:b])
            i = int(np.searchsorted(ends, done - a))
            if ends[i] != done - a:  # the chunk's own tokens do not begin here: encode up to the next agreement
                hi = self._after(safe, b, len(text))
                out.append(self.plain(text[done:hi]))
                done = hi
                continue
            if b == len(text):
                out.append(ids[i:])
                break
            before = safe[: np.searchsorted(safe, b, side="right")]
            lo, j = done, i
            for s in before[-8:][::-1]:  # the nearest safe position at which this chunk's tokens also end
                if s <= done:
                    break
                e = int(np.searchsorted(ends, s - a))
                if s > a and e < len(ends) and ends[e] == s - a:
                    lo, j = int(s), e
                    break
            out.append(ids[i:j])
            if lo == b:
                done = b
                continue
            hi = self._after(safe, b, len(text))
            out.append(self.plain(text[lo:hi]))
            done = hi
        return np.concatenate(out) if len(out) != 1 else out[0]

    @staticmethod
    def _after(safe: np.ndarray, at: int, end: int) -> int:
        """The first safe position at or after `at`, else the end."""
        i = int(np.searchsorted(safe, at))
        return int(safe[i]) if i < len(safe) else end

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column and where each row's begin and end (n + 1 offsets)."""
        raw, offsets = text_buffer(texts)
        found, step = [], BLOCK
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, side="right")) - 1)
            part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            cuts, safe = self.cuts(part, at), self.safe(part)
            c, s = np.searchsorted(cuts, at, side="right"), np.searchsorted(safe, at, side="right")
            data = part.tobytes()
            for r in range(j - i):
                own = cuts[c[r] : c[r + 1]] - at[r]
                own_safe = safe[s[r] : s[r + 1]] - at[r]
                text = data[at[r] : at[r + 1]]
                end = len(text)
                found.append(self.encode_text(text, [x for x in own.tolist() if 0 < x < end], own_safe[own_safe < end]))
            i = j
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int32), np.concatenate([[0], np.cumsum(sizes)])

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """Each row's text as UTF-8: its tokens' bytes; bytes that are no UTF-8 give replacement characters."""
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            row = ids[a:b]
            n = self.lengths[row]
            ends = np.cumsum(n)
            index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.at[row] - ends + n, n)
            data = self.bytes[index].tobytes()
            try:
                data.decode()
            except UnicodeDecodeError:
                data = data.decode(errors="replace").encode()
            yield data


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k") -> Encoder:
    """One encoder in a worker process, over the installed public vocabulary files."""
    import public_tokenizers as files

    return Encoder(files.path(f"{name}.json"), files.path(f"{name}.tiktoken"), files.PATTERN, {"<|endoftext|>": 50256})


_DIGITS = np.zeros((0, 0), dtype=np.uint8)


def decimal(ids: np.ndarray) -> bytes:
    """Decimal ids joined by commas."""
    global _DIGITS
    if len(_DIGITS) <= (top := int(ids.max(initial=0))):
        _DIGITS = np.frombuffer(b"".join(f"{i},".rjust(8).encode() for i in range(max(top + 1, 50257))), dtype=np.uint8).reshape(-1, 8)
    shown = _DIGITS[ids].reshape(-1)
    return shown[shown != 0x20].tobytes()[:-1]


def encode(df: DataFrame, text: str = "text", name: str = "byte_bpe_50k") -> DataFrame:
    """df with a column ids array<int>: the tokens of its text column. Narrow: no shuffle."""
    kept = [c for c in df.columns if c != "ids"]
    rows = df.select(*(F.col(f"`{c}`") for c in kept))
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        for b in batches:
            ids, at = enc.encode_column(b.column(text))
            made = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), made], [*kept, "ids"])
        give_back()

    return rows.mapInArrow(run, schema)


def round_trip(df: DataFrame, name: str = "byte_bpe_50k") -> DataFrame:
    """df (doc_id, text) as (doc_id, n_tokens, ids_sha256, decoded_sha256), encoded and decoded. Narrow: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        for b in batches:
            ids, at = enc.encode_column(b.column("text"))
            shown = [hashlib.sha256(decimal(ids[i:j])).hexdigest() for i, j in zip(at[:-1], at[1:], strict=True)]
            back = [hashlib.sha256(x).hexdigest() for x in enc.decode_column(ids, at)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(at)), pa.array(shown, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        give_back()

    small_batches(df.sparkSession)
    kind = dict(df.dtypes)["doc_id"]
    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
