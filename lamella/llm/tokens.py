"""Token ids of a whole corpus by a public byte-level tokenizer, character offsets, and decoding.

The tokenizers library runs over Arrow batches. Its pre-tokens never begin inside a run of non-space characters and
the white space before it that starts right after another such run, so a text is cut there into pieces without
changing any id, and each distinct piece of a worker is encoded once. A null or empty text has no ids; strings that
look like special tokens are ordinary text. Repeated rows give repeated rows; columns besides the key are not read.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Unicode White_Space, as the tokenizer's own pattern understands \s.
_SPACE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: In ASCII text a run of letters is a piece of its own too: pre-tokens end there, save that an apostrophe may begin one
#: that goes on with letters.
ASCII_PIECE = re.compile(r"[\t-\r ]*(?:[A-Za-z]+|[^\t-\r A-Za-z]+(?:(?<=')[A-Za-z]+)?)|[\t-\r ]+")
#: Distinct pieces that a worker keeps; beyond it starts anew.
CACHE_PIECES = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """One tokenizer of a worker process, with the ids of the pieces it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        new = list(pieces)
        for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.known[p] = np.array(e.ids, dtype=np.int32).tobytes()

    def encode(self, texts: list[str | None], block: int = 256) -> Iterator[tuple[bytes, list[int]]]:
        """For every block of texts, their ids as bytes of int32, one after the other, and the length of each in ids."""
        for i in range(0, len(texts), block):
            cut = [(ASCII_PIECE if t.isascii() else PIECE).findall(t) if t else [] for t in texts[i : i + block]]
            if len(self.known) > CACHE_PIECES:
                self.known = {}
            self.learn(set().union(*cut).difference(self.known))
            ids = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
            yield b"".join(ids), [len(b) // 4 for b in ids]


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes of each id."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    alphabet = byte_alphabet()
    size = 1 + max([*model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens", []))])
    table = [b""] * size
    for token, i in model["model"]["vocab"].items():
        table[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    for t in model.get("added_tokens", []):
        table[t["id"]] = t["content"].encode()
    return tuple(table)


def decode(ids: Iterable[int], path: str) -> str:
    """The text of ids; bytes that form no character become U+FFFD."""
    table = token_bytes(path)
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


def decode_parts(parts: Iterable[Iterable[int]], path: str) -> Iterator[str]:
    """The text of each part of a cut id list: a character whose bytes are split between parts comes with the last of them."""
    table, reader = token_bytes(path), codecs.getincrementaldecoder("utf-8")("replace")
    for ids in parts:
        yield reader.decode(b"".join([table[i] for i in ids]))
    if rest := reader.decode(b"", True):
        yield rest


def offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last of each token; tokens that share a character overlap in it."""
    table = token_bytes(path)
    size = np.fromiter((len(table[i]) for i in ids), dtype=np.int64, count=len(ids))
    end = np.cumsum(size)
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    if not len(ids):
        return end, end
    return char[end - size], char[end - 1] + 1


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, ids`` for every row of ``docs``."""
    where = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(where)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            for ids, sizes in encoder.encode(texts):
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(ids, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(sizes)), lists], names=[key, "ids"])
                at += len(sizes)

    return docs.select(key, text).mapInArrow(work, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


def corpus_offsets(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, ids, starts, ends``: character offsets of each token of a text."""
    where = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(where)
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(next(encoder.encode([t]))[0], dtype=np.int32)
                starts, ends = offsets(t or "", ids, where)
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([k], batch.schema.field(0).type), *[pa.array([x.astype(np.int32)], kind) for x in (ids, starts, ends)]], names=[key, "ids", "starts", "ends"])

    return docs.select(key, text).mapInArrow(work, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, n_chars, exact``: whether decoding a text's ids gives the text, whole and in two parts cut in the middle."""
    where = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(where)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            exact = []
            for ids, sizes in encoder.encode(texts):
                flat, at = np.frombuffer(ids, dtype=np.int32), 0
                for n in sizes:
                    own, at = flat[at : at + n].tolist(), at + n
                    whole = texts[len(exact)]
                    exact.append(decode(own, where) == whole and "".join(decode_parts([own[: n // 2], own[n // 2 :]], where)) == whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(exact, pa.bool_())], names=[key, "n_chars", "exact"])

    return docs.select(key, text).mapInArrow(work, f"{key} {docs.schema[key].dataType.simpleString()}, n_chars bigint, exact boolean")
