"""Token counts of whole texts, huge ones by overlap resynchronisation.

A huge text is encoded in chunks that overlap, with offsets. Two neighbours
are spliced at a stable common boundary inside their overlap: a place where
both begin a token, that follows white space (normaliser and pre-tokeniser of
such a file never look across white space, so the text encodes to the left
part's tokens followed by the right part's), and from which both give the same
ids and offsets for a run of tokens. If the overlap has none, it is
widened, up to the rest of the text. The result equals the library's for the
text in one piece, and no encoding of more than a chunk is held.

Shorter texts are encoded by white-space separated pieces, each distinct piece
once for a worker (the memory is bounded and emptied when full).

Defined cases: null is empty and has 0 tokens; repeated rows each count; a null
doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.common import arrow_map

TOKENIZER = "word_bpe_49k.json"
#: Characters in a chunk; texts of more are huge.
CHUNK = 32_768
OVERLAP = 256
#: Tokens on which both sides must agree from the boundary on.
RUN = 6
MAX_PIECES = 1_200_000
MAX_PIECE_BYTES = 256
TAIL = b".,!?;:"
SPACE = frozenset(" \t\n\r\x0b\x0c")


def tokenizer(name: str):
    """The library's tokenizer for a file of ``public_tokenizers``, one thread, made once for a worker."""
    made = vars(sys).setdefault("_riskfeat_tokenizers", {})
    if name not in made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        made[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return made[name]


class Encoder:
    """ids of texts as little-endian 32-bit numbers in bytes, through a bounded memory of pieces."""

    def __init__(self, name: str = TOKENIZER):
        self.lib = tokenizer(name)
        # kept with the worker's Python, so that its next task finds it
        self.known: dict[bytes, bytes] = vars(sys).setdefault("_riskfeat_pieces", {}).setdefault(name, {})

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces, without signs at their end: a sign after an ASCII letter or digit is always a token of its own."""
        known, new, split = self.known, [], []
        for p in pieces:
            core = p.rstrip(TAIL)
            if core and core is not p and len(core) < len(p) and core[-1] < 128 and chr(core[-1]).isalnum():
                tail = p[len(core):]
                split.append((p, core, tail))
                new += [x for x in (core, tail) if x not in known]
            else:
                new.append(p)
        new = list(dict.fromkeys(new))
        for x, e in zip(new, self.lib.encode_batch_fast([x.decode() for x in new], add_special_tokens=False), strict=True):
            known[x] = array("I", e.ids).tobytes()
        for p, core, tail in split:
            known[p] = known[core] + known[tail]

    def ids(self, text: str) -> bytes:
        return encode_huge(text, self.lib) if len(text) > CHUNK else self.pieces(text)

    def pieces(self, text: str) -> bytes:
        """By white-space separated pieces, whatever the length."""
        raw = text.encode()
        if b"<|" not in raw:  # the file lower-cases, but not its special strings
            raw = raw.lower()
        pieces, known = raw.split(), self.known
        if len(known) > MAX_PIECES:
            known.clear()
        missing = set(pieces).difference(known)
        if missing:
            long = [p for p in missing if len(p) > MAX_PIECE_BYTES]
            self._learn([p for p in missing if len(p) <= MAX_PIECE_BYTES])
            if long:  # not remembered
                return b"".join(known[p] if p in known else np.array(
                    self.lib.encode(p.decode(), add_special_tokens=False).ids, "<u4").tobytes() for p in pieces)
        return b"".join(map(known.__getitem__, pieces))


def stable_boundary(text: str, left: list[tuple[int, int, int]], right: list[tuple[int, int, int]],
                    run: int = RUN) -> int | None:
    """The first place where both (start, end, id) lists begin a token after white space and agree for ``run`` tokens
    (or, at the text's end, for all that follow)."""
    at = {t[0]: k for k, t in enumerate(left)}
    for k, t in enumerate(right):
        p = t[0]
        if p in at and p > 0 and text[p - 1] in SPACE:
            a, b = left[at[p]:at[p] + run], right[k:k + run]
            if a == b and (len(a) == run or a[-1][1] == len(text.rstrip())):
                return p
    return None


def encode_huge(text: str, lib, chunk: int = CHUNK, overlap: int = OVERLAP) -> bytes:
    """ids of a text by overlapping chunks, spliced where neighbours resynchronise."""
    def encode(a: int, b: int) -> list[tuple[int, int, int]]:
        e = lib.encode(text[a:b], add_special_tokens=False)
        return [(a + s, a + t, i) for (s, t), i in zip(e.offsets, e.ids, strict=True)]

    n, out, begin = len(text), [], 0
    while True:
        # here the text is cut at `begin`, which is its start or a stable boundary
        end, wide = begin + chunk, overlap
        if end + wide >= n:
            out += [i for _, _, i in encode(begin, n)]
            return np.array(out, "<u4").tobytes()
        while True:
            left = encode(begin, min(n, end + wide))
            cut = stable_boundary(text, [t for t in left if t[0] >= end], encode(end, min(n, end + 2 * wide)))
            if cut is not None:
                out += [i for s, _, i in left if s < cut]
                begin = cut
                break
            if end + wide >= n:
                out += [i for _, _, i in left]
                return np.array(out, "<u4").tobytes()
            wide *= 2


def token_counts(docs: DataFrame, limit: int = 2048, name: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row. One narrow pass, no shuffle."""
    def one(b: pa.RecordBatch):
        enc = Encoder(name)
        n = [len(enc.ids(x)) // 4 if x else 0 for x in b.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                                          ["doc_id", "n_bytes", "n_tokens"])

    plain = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return (arrow_map(plain, one, docs.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
